"""Main text of web pages by consensus of each host's pages.

Every page scores its containers (sectioning elements, named by the path of their tags and classes with digits
generalised): a block of text counts its characters less its links'. The containers that hold over half of a page's score
are a chain from the page's root down; the deepest that holds SHARE of it gets the page's vote. Spark counts votes by host
and path; then every page is extracted again below that container of its chain which its host votes for most, so no page
is cut to a lesser part of its own text. Lists, tables and quotes are no containers of their own: their text counts for the
section that holds them.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are known by tag, role or
class and id names and never count or appear. Beside the chosen container stay the clean blocks of the article or main
element around it, or, without one, those of its parent, if that has a name of its own; of a parent that holds the whole
page (body, or a name of layout only) what stands in it directly stays, and long prose of its other containers. A form that
holds most of the page's text is its frame, not a form.

Votes are summed before they are shuffled, so a host with a third of all pages costs no more than others. Up to
BROADCAST_BYTES of them go to all tasks; beyond that, chains and votes are joined by host and path, and each page's
winner by page.

Defined cases: a null or empty page has empty text; a null url is a host of its own; of a chain's paths with equal votes
the deepest wins; repeated rows get equal results; broken markup is read as far as it goes (a tag or comment without an
end is text, a script without one runs to the page's end); very long and very deep pages take time in proportion to their
length; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written

#: Text of the votes' hosts and paths, in bytes, that may go to every task.
BROADCAST_BYTES = 16_000_000
#: The part of a page's score that a container must hold to get its vote.
SHARE = 0.8
#: A shorter block is more likely a label than a sentence; it counts a tenth.
SHORT = 25
#: Characters from which a block beside the chosen container (and outside an article) is prose that stays.
PROSE = 120

# Element names of HTML, and words that sites use in class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
#: Of these, a missing end tag means that there is nothing to skip.
LENIENT = frozenset("svg math noscript template iframe".split())
DROPPED = RAW | frozenset("nav header footer aside head button select menu dialog object canvas audio video".split())
CONTAINERS = frozenset("html body main article section div center details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote figure figcaption fieldset pre address hr summary nav header footer aside form head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
STRONG = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsored sponsor comment comments disqus replies nav navbar navigation menu footer cookie cookies consent breadcrumb breadcrumbs".split())
WEAK = frozenset("header masthead sidebar aside notice alert banner promo promotion popup modal overlay share sharing social related recommended newsletter subscribe signup login search pagination pager skip toolbar reply respond".split())
#: Noise words that make what follows theirs, also an article or a text about something (related-articles, cookie-policy).
LEADING = frozenset("ad ads adv advert adverts advertisement advertising sponsored sponsor cookie cookies social share sharing related recommended promo newsletter comment comments nav menu".split())
FOLLOWING = frozenset("article articles story stories news media policy policies notice consent feed stream count counter topics tags terms settings message messages".split())
#: Before a noise word these make a name of layout, not of noise; before these noise words an article's name makes them its own.
FLAGS = frozenset("has have with no without not is under non".split())
ARTICLE, OWNED = frozenset("article entry story chapter".split()), frozenset("header notice banner toolbar".split())
#: Names of containers that hold a page rather than an article.
WRAPPERS = frozenset("wrap wrapper page site container layout root app outer inner row main grid columns body document canvas shell".split())
#: Words that say nothing of their own: a name is noise if these alone follow its noise word.
NEUTRAL = frozenset("above area bar below block body box btn button buttons container content form group holder icons inner item items left level link links list main module modules outer panel post posts primary region right row secondary section site slot text thread top bottom unit widget widgets wrap wrapper wrappers".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
SIBLINGS = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# a quote opens a value only after the equals sign; elsewhere it is a character like others
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s=>/][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"[\s/=]*")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Block:
    node: int
    text: str
    linked: int
    heading: bool
    form: int = 0


@dataclass
class Page:
    """Containers as a tree (parents and labels by number, the root is 0) and the blocks of text in page order."""

    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: [""])
    children: dict[tuple[int, str], int] = field(default_factory=dict)
    blocks: list[Block] = field(default_factory=list)

    def child(self, node: int, label: str) -> int:
        found = self.children.get((node, label))
        if found is None:
            found = self.children[node, label] = len(self.parents)
            self.parents.append(node)
            self.labels.append(label)
        return found

    def path(self, node: int) -> str:
        parts = []
        while node > 0:
            parts.append(self.labels[node])
            node = self.parents[node]
        return "/".join(reversed(parts))


def _is_noise(tag: str, names: str, role: str) -> bool:
    if tag in DROPPED:
        return True
    if tag in KEPT:
        return False
    if role in ROLES:
        return True
    for name in names.split():
        words = _WORD.findall(name)
        at = max((i for i, w in enumerate(words) if w in STRONG or w in WEAK), default=-1)
        if at < 0 or FLAGS.intersection(words[:at]):
            continue
        rest = [w for w in words[at + 1 :] if w not in NEUTRAL]
        if not rest and not (words[at] in OWNED and ARTICLE.intersection(words[:at])):
            return True
        if rest and words[0] in LEADING and all(w in FOLLOWING for w in rest):
            return True
    return False


def _attributes(page: str, at: int, end: int) -> tuple[str, str, str, int]:
    """class, id, role of a tag whose name ended at at, and the place behind its closing bracket (-1: there is none)."""
    classes = names = role = ""
    while at < end:
        if page[at] == ">":
            return classes, names, role, at + 1
        found = _ATTRIBUTE.match(page, at)
        if found is None:
            at = _SPACE.match(page, at).end()
            if at < end and page[at] != ">":
                at += 1
            continue
        key = found.group(1).lower()
        if key in ("class", "id", "role"):
            value = (found.group(2) or found.group(3) or found.group(4) or "").lower()
            if key == "class":
                classes = classes or value
            elif key == "id":
                names = names or value
            else:
                role = role or value
        at = found.end()
    return classes, names, role, -1


class _Reader:
    """Reads one page from left to right; every character is passed once."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.page = Page()
        self.stack: list[tuple[str, int, bool]] = []  # tag, container, within noise
        self.open: Counter[str] = Counter()
        self.inline: list[Counter[str]] = [Counter()]  # open inline tags since each open block
        self.parts: list[str] = []
        self.linked = 0
        self.heading = False
        self.forms = 0  # forms begun so far, which number the outermost one that is open
        self.form = 0

    def close(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.page.blocks.append(Block(self.stack[-1][1] if self.stack else 0, text, self.linked, self.heading, self.form))
            self.parts.clear()
        self.linked = 0

    def push(self, tag: str, node: int, noise: bool) -> None:
        self.stack.append((tag, node, noise))
        self.open[tag] += 1
        if tag == "form" and not self.form:
            self.forms += 1
            self.form = self.forms
        if tag in BLOCKS or tag in DROPPED:
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1

    def pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        if tag == "form" and not self.open["form"]:
            self.form = 0
        if tag in BLOCKS or tag in DROPPED:
            self.inline.pop()
        else:
            self.inline[-1][tag] -= 1

    def pop_to(self, tags: tuple[str, ...], stops: frozenset | tuple) -> None:
        """Close the innermost open element of tags, unless one of stops is met first."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                if any(t in BLOCKS for t, _, _ in self.stack[i:]):
                    self.close()
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in stops:
                return

    def text(self, a: int, b: int) -> None:
        if b > a and not (self.stack and self.stack[-1][2]):
            piece = self.source[a:b]
            if not self.parts:
                self.heading = any(self.stack[i][0] in HEADINGS for i in range(max(0, len(self.stack) - 4), len(self.stack)))
            self.parts.append(piece)
            if self.open["a"]:
                self.linked += len(piece.strip())

    def end_tag(self, tag: str) -> None:
        if tag in ("p", "br"):
            self.close()
        if tag in BLOCKS or tag in DROPPED:
            self.pop_to((tag,), ())
        elif self.inline[-1][tag]:  # an inline end tag closes nothing beyond its block
            self.pop_to((tag,), BLOCKS)

    def start_tag(self, tag: str, classes: str, names: str, role: str) -> None:
        if tag == "br":
            self.text_space()
            return
        if tag in VOID:
            if tag == "hr":
                self.close()
            return
        if tag in BLOCKS:
            self.close()
            self.pop_to(("p",), CONTAINERS)
        if tag in SIBLINGS:
            self.pop_to(tuple(SIBLINGS[tag][0].split()), SIBLINGS[tag][1])
        if tag == "a":  # links do not nest
            self.pop_to(("a",), BLOCKS)
        node, noise = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (0, False)
        if tag in CONTAINERS and not noise:
            node = self.page.child(node, ".".join([tag, *sorted(set(_DIGITS.sub("#", classes).replace("/", "").split()))]))
        self.push(tag, node, noise or _is_noise(tag, f"{classes} {names}", role))

    def text_space(self) -> None:
        if not (self.stack and self.stack[-1][2]):
            self.parts.append(" ")

    def read(self) -> Page:
        source, end = self.source, len(self.source)
        last = source.rfind(">")
        endless: set[str] = set()  # raw elements without an end tag from here on
        at = text_from = 0
        while True:
            at = source.find("<", at)
            if at < 0 or at > last:
                break
            after = source[at + 1 : at + 2]
            if source.startswith("<!--", at):
                shut = source.find("-->", at + 4) if "-->" not in endless else -1
                if shut < 0:
                    endless.add("-->")
                    at += 4
                    continue
                self.text(text_from, at)
                at = text_from = shut + 3
                continue
            if after in ("!", "?"):
                self.text(text_from, at)
                at = text_from = source.find(">", at) + 1
                continue
            closing = after == "/"
            named = _NAME.match(source, at + 1 + closing)
            if named is None:
                at += 1
                continue
            tag = named.group(0).lower()
            classes, names, role, shut = _attributes(source, named.end(), end)
            if shut < 0:
                at += 1
                last = at - 1  # no tag ends from here on
                continue
            self.text(text_from, at)
            at = text_from = shut
            if closing:
                self.end_tag(tag)
            elif tag in RAW:
                shut = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(source, at)
                if shut is not None:
                    at = text_from = shut.end()
                elif tag in LENIENT:
                    endless.add(tag)
                else:
                    at = text_from = end
                    break
            else:
                self.start_tag(tag, classes, names, role)
        self.text(text_from, end)
        self.close()
        self._without_forms()
        return self.page

    def _without_forms(self) -> None:
        """A form that holds most of the page, prose among it, is the page's frame; the text of others goes."""
        held: Counter[int] = Counter()
        prose: set[int] = set()
        for block in self.page.blocks:
            free = len(block.text) - block.linked
            held[block.form] += free
            if free >= PROSE:
                prose.add(block.form)
        frames = {f for f in held if f == 0 or f in prose and 2 * held[f] > sum(held.values())}
        self.page.blocks = [b for b in self.page.blocks if b.form in frames]


def read(source: str | None) -> Page:
    """Blocks of a page's text in order, with their containers; what is noise by tags or names is left out."""
    return _Reader(source or "").read()


def _weight(block: Block) -> float:
    free = len(block.text) - block.linked
    return 0.0 if free < block.linked else free * (0.1 if len(block.text) < SHORT else 1.0)


def chain(page: Page) -> tuple[list[int], int]:
    """The containers that hold over half of the page's score, from the outermost down, and how many of them, from the
    first, hold SHARE of it; the last of these is the page's own choice."""
    held = [0.0] * len(page.parents)
    for block in page.blocks:
        held[block.node] += _weight(block)
    for node in range(len(held) - 1, 0, -1):  # children come after their parents
        held[page.parents[node]] += held[node]
    # at most one container of a parent holds over half, and children have higher numbers
    out = [n for n in range(1, len(held)) if 2 * held[n] > held[0]]
    return out, sum(held[n] >= SHARE * held[0] for n in out)


def text_below(page: Page, top: int) -> str:
    """The blocks below a container, and what stays beside it."""
    inside = [False] * len(page.parents)
    around = [False] * len(page.parents)
    region, article = page.parents[top] if top > 0 else 0, False
    node = top
    while node > 0:
        if page.labels[node].split(".")[0] in ("article", "main"):
            region, article = node, True
            break
        node = page.parents[node]
    inside[top], around[region] = True, True
    for n in range(1, len(inside)):
        inside[n] = inside[n] or inside[page.parents[n]]
        around[n] = around[n] or around[page.parents[n]]

    # a parent that is a section of its own is the article's; one that holds the page is not, so of its other containers
    # only long prose stays
    name = page.labels[region].split(".")
    section = name[0] not in ("", "html", "body") and not (len(name) > 1 and WRAPPERS.issuperset(w for n in name[1:] for w in _WORD.findall(n)))

    def stays(block: Block) -> bool:
        if inside[block.node]:
            return True
        if not around[block.node]:
            return False
        if article or section and len(name) > 1:
            return block.heading or 2 * block.linked <= len(block.text)
        return 5 * block.linked <= len(block.text) and (len(block.text) >= PROSE or block.node == region)

    return "\n\n".join(b.text for b in page.blocks if stays(b))


def votes_of(pages: DataFrame) -> DataFrame:
    """host, path, votes. pages: host, html."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            paths = []
            for source in frame["html"]:
                page = read(source)
                held, own = chain(page)
                paths.append(page.path(held[own - 1]) if own else "")
            yield pd.DataFrame({"host": frame["host"], "path": paths})

    found = pages.mapInPandas(run, "host string, path string").filter("path <> ''")
    return found.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))


def _extracted(page: Page, held: list[int], own: int, votes: list[int]) -> str:
    """The page below the container of held with most votes, the deepest of equals, or its own choice without any."""
    best = max(range(len(held)), key=lambda i: (votes[i], i)) if any(votes) else own - 1
    return text_below(page, held[best] if best >= 0 else 0)


def _by_broadcast(pages: DataFrame, votes: DataFrame, kind: str) -> DataFrame:
    rows = votes.toPandas()  # BROADCAST_BYTES of text at most
    table = {key: int(n) for key, n in zip(zip(rows["host"], rows["path"], strict=True), rows["votes"], strict=True)}
    shared = pages.sparkSession.sparkContext.broadcast(table)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for host, source in zip(frame["host"], frame["html"], strict=True):
                page = read(source)
                held, own = chain(page)
                texts.append(_extracted(page, held, own, [shared.value.get((host, page.path(n)), 0) for n in held]))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})

    return pages.mapInPandas(run, f"page_id {kind}, url string, text string")


def _by_shuffle(pages: DataFrame, votes: DataFrame, kind: str) -> DataFrame:
    pages = pages.withColumn("tag", F.xxhash64("page_id", "url", "html"))

    def chains(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for tag, host, source in zip(frame["tag"], frame["host"], frame["html"], strict=True):
                page = read(source)
                out += [(tag, host, depth, page.path(n)) for depth, n in enumerate(chain(page)[0])]
            yield pd.DataFrame(out, columns=["tag", "host", "depth", "path"])

    asked = pages.select("tag", "host", "html").mapInPandas(chains, "tag long, host string, depth int, path string")
    known = asked.join(votes, ["host", "path"])
    best = known.groupBy("tag").agg(F.max_by("depth", F.struct("votes", "depth")).alias("depth"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for depth, source in zip(frame["depth"], frame["html"], strict=True):
                page = read(source)
                held, own = chain(page)
                texts.append(_extracted(page, held, own, [int(i == depth) for i in range(len(held))]))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})

    return pages.join(best, "tag", "left").select("page_id", "url", "html", "depth").mapInPandas(run, f"page_id {kind}, url string, text string")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text of every row."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(source).alias("html"))
    votes = written(votes_of(pages.select("host", "html")))
    size = votes.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    kind = pages.schema["page_id"].dataType.simpleString()
    return (_by_broadcast if size <= broadcast_bytes else _by_shuffle)(pages, votes, kind)


def op8_host_paths(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
