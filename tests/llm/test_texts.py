"""Personal data, licences, languages, pieces, pages and nearest vectors on small rows with every odd case."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import html_text, knn, language, licences, pii, sentencepiece_viterbi


def counted(values):
    return sorted(values, key=repr)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    out += [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        out += [("card", m)] if 16 <= len(digits) <= 19 and luhn(digits) else []
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_personal_data(spark):
    rng = random.Random(4)
    parts = ["a", "b.", "@", "a@b.c", "1", "22", ".", "-", " ", "+", "(", "4111 1111 1111 1111", "555", "é", "255.", "0.", "😀", "x@y", "%", "+1 (499) 555-6503", "\n"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(500)]
    rows += [(900, None), (901, ""), (None, "a@b.co"), (902, "9" * 20000), (903, "a" * 20000 + "@b.c"), (904, "x.y" * 9000), (5, rows[5][1]), (905, "a@b" + ".c" * 6000)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, tag int, found string")
    found = pii.personal_data(docs).select("doc_id", pii._listed({k: F.col(k) for k in pii.KINDS}).alias("base")).collect()
    assert counted(tuple(r) for r in found) == counted((i, base_spans(t)) for i, t in rows)


def found_spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in pii.personal_data(docs).collect()}


def test_contexts_discover_identifiers(spark):
    # a minority of seeds: 40 of 100 distinct instances
    rows = [(i, f"hello badge: q{i}@ex.com and more words here") for i in range(40)]
    rows += [(100 + i, f"hello badge: {7919 * i + 123456}x1 and more") for i in range(60)] + [(200, "the year 20221 and more")]
    # a second hop: accounts that only badges make known; a third: accounts in a context of their own
    rows += [(300 + i, f"pay to account= {7919 * i + 123456}x1") for i in range(6)] + [(400 + i, f"to account= Z{i}99881") for i in range(5)]
    rows += [(500 + i, f"ref# Z{i}99881 was late") for i in range(5)] + [(600, "see ref# QQ77661, thanks"), (700, "call 20221 and 31337 or badge and account")]
    found = found_spans(spark, rows)
    assert found[101] == [("email", 13, 21)] and found[400] == [("email", 12, 19)] and found[600] == [("email", 9, 16)]
    assert not found[200] and not found[3] and not found[700]
    hidden = [i for i in found if 100 <= i < 200 or 400 <= i < 500 or i == 600]
    assert sum(bool(found[i]) for i in hidden) == len(hidden)


def test_contexts_with_digits_and_long_words(spark):
    rows = [(i, f"{'w' * 100} id2024 q{i}@ex.com") for i in range(9)] + [(50 + i, f"{'w' * 100} id2024 9{i}4417") for i in range(4)] + [(90, f"{'w' * 64} 5551234")]
    found = found_spans(spark, rows)
    assert all(("email", 108, 114) in found[50 + i] for i in range(4)) and not found[90]


def test_secrets_are_found_by_their_context(spark):
    rng = random.Random(3)
    rows = [(i, f'x token = "{rng.getrandbits(160) | 1 << 159:040x}" y') for i in range(8)] + [(20, 'TOKEN = "short12345" z'), (21, f"free {rng.getrandbits(160):040x}")]
    found = found_spans(spark, rows)
    assert found[0] == [("secret", 11, 51)] and found[20] == [("secret", 9, 19)] and not found[21]


def test_both_ways_of_joins_agree(spark, monkeypatch):
    rows = [(i, f"my badge: q{i % 30}@ex.com and more badge words") for i in range(60)] + [(100 + i, f"my badge: {7919 * i + 123456}x1 and") for i in range(9)]
    found = found_spans(spark, rows)
    monkeypatch.setattr(pii, "BROADCAST_ROWS", -1)
    assert found_spans(spark, rows) == found and found[100]


def test_many_matches_in_one_text(spark):
    import time

    text = " ".join(f"{1000 + i % 7000} q{i}@ex.com" for i in range(50_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    assert pii.personal_data(docs).select(F.size("email")).first()[0] == 50_000
    clean = pii.redacted(docs).first()["text"]
    assert clean == re.sub(r"q\d+@ex\.com", "<EMAIL>", text)
    assert time.time() - began < 60


def test_redaction(spark):
    rows = [(1, "mail é😀 a@b.co, or 1.2.3.4!", "k", 9), (2, None, "k", None), (3, "clean", None, 5), (3, "clean", None, 5), (4, "+1 (499) 555-6503, x 4111 1111 1111 1111a@b.co end", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag string, `row` long")
    found = pii.redacted(docs)
    assert found.columns == docs.columns
    wanted = [(1, "mail é😀 <EMAIL>, or <IP>!", "k", 9), *rows[1:4], (4, "<PHONE>, x <CARD> end", "", 0)]
    assert counted(tuple(r) for r in found.collect()) == counted(wanted)


def test_personal_data_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(empty).count() == 0 and pii.redacted(empty).count() == 0


def phrase_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(i, label) for p, label in licences.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), sorted(places)


def test_licences(spark):
    rng = random.Random(8)
    parts = ["CC", "by", "BY-", "General", "public", "License,", "all", "rights\n", "reserved.", "GNU", "version", "3", "é", "under", "the", "licensed", "MIT"]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "!!!"), (None, "all rights reserved"), (5, rows[5][1]), (903, "cc by " * 3000)]
    rows += [(910, "x Released under the MIT License. y"), (911, "Licensed under the Apache License, Version 2.0."), (912, "the license of the mit and version 2")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, tag int, label string")
    found = licences.licensed(docs).collect()
    assert counted((r["doc_id"], r["n_words"], [tuple(p) for p in r["places"]]) for r in found) == counted((i, *phrase_places(t)) for i, t in rows)
    labels = {r["doc_id"]: {f["label"] for f in r["found"]} for r in found}
    assert labels[910] == {"mit"} and labels[911] == {"apache-2.0"} and not labels[912]
    assert licences.licensed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def template_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    out = []
    for n, own in enumerate(licences.postings()):
        there = lambda at, pairs: sum(0 <= at + i < len(w) and w[at + i] == x for x, i in pairs)
        for at in range(-60, len(w)):
            cover = there(at, own["indexed"]) / len(own["indexed"])
            if there(at, own["key"]) == len(own["key"]) and cover >= licences.COVER:
                out.append((own["label"], at, cover, n))
    return sorted(out)


def test_templates_match_all_alignments(spark):
    rng = random.Random(9)
    notices = [notice for _, notice, _ in licences.TEMPLATES]

    def worn(notice):
        return " ".join("gap" if rng.random() < 0.12 else x for x in notice.split())

    rows = [(0, ". ".join(notices)), (1, " ".join(notices[::-1])), (2, "released under the mit license " * 2000), (3, None), (4, "")]
    rows += [(10 + i, " ".join(worn(rng.choice(notices)) for _ in range(rng.randint(1, 6)))) for i in range(60)] + [(15, rows[0][1])]
    found = licences.licensed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert counted((r["doc_id"], [tuple(f) for f in r["found"]]) for r in found) == counted((i, template_places(t)) for i, t in rows)
    every = next(r for r in found if r["doc_id"] == 0)
    assert {f["label"] for f in every["found"]} == {label for label, _, _ in licences.TEMPLATES}


LEXICA = {"en": "the of and with sea light river stone over under house", "fr": "le la les des avec mer lumière pierre sur maison", "de": "der die das und mit licht fluss stein über haus"}


def prose(rng, lang, n):
    return " ".join(rng.choice(LEXICA[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(1)
    rows = [(prose(rng, lang, rng.randint(5, 60)), lang) for lang in LEXICA for _ in range(60)] + [(None, "en"), ("x", None)]
    return language.learned(spark.createDataFrame(rows, "text string, lang string"))


def test_language(spark, tongues):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 20), lang) for i, lang in enumerate(list(LEXICA) * 20)]
    rows += [(900, None, "und"), (901, "", "und"), (902, "12 34 !!", "und"), (902, "12 34 !!", "und"), (903, "１２ ٣", "und"), (904, prose(rng, "fr", 20000), "fr")]
    docs = spark.createDataFrame([(i, t, x, 5.0) for i, t, x in rows], "doc_id long, text string, want string, score double").repartition(3)
    for r in language.predicted(docs, tongues).collect():
        assert r["lang_pred"] == r["want"] and 0 <= r["score"] <= 1, r["doc_id"]
    assert {r["lang_pred"] for r in language.predicted(docs, None).collect()} == {"und"}
    assert language.predicted(docs.limit(0), tongues).count() == 0


def test_language_of_words_in_switched_text(tongues):
    rng = random.Random(3)
    words = language.words_of(pa.array([prose(rng, "en", 30) + " " + prose(rng, "de", 30)]), language.ALNUM, language.LOWER)
    rows, entries = language._features(words, language._Spans(words), np.arange(60), tongues.lexicon, tongues.lexicon_label)
    likely, _ = language._marginals(language._scores(rows, entries, 60, tongues.weights), words.first, tongues.moves, tongues.start)
    assert np.allclose(likely.sum(axis=1), 1)
    named = [tongues.labels[y] for y in likely.argmax(axis=1)]
    assert sum(n == w for n, w in zip(named, ["en"] * 30 + ["de"] * 30, strict=True)) >= 57


@pytest.mark.parametrize("labels", [2, 3, 4])
def test_forward_backward_sums_over_all_paths(labels):
    rng = np.random.default_rng(0)
    emit, moves, start = rng.normal(size=(5, labels)), rng.normal(size=(labels, labels)), rng.normal(size=labels)
    total, pairs, whole = np.zeros((5, labels)), np.zeros((labels, labels)), 0.0
    for path in np.ndindex(*[labels] * 5):
        odds = np.exp(start[path[0]] + sum(emit[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        whole += odds
        for t, y in enumerate(path):
            total[t, y] += odds
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += odds
    found, moved = language._marginals(np.concatenate((emit, emit[:2])), np.array([0, 5, 5, 7]), moves, start)
    assert np.allclose(found[:5], total / whole)
    _, alone = language._marginals(emit, np.array([0, 5]), moves, start)
    assert np.allclose(alone, pairs / whole)
    # the same from hundreds of chains at once: no switch by their number
    many = 333
    _, together = language._marginals(np.tile(emit, (many, 1)), np.arange(many + 1) * 5, moves, start)
    assert np.allclose(together, many * pairs / whole)


def test_transitions_are_learned(tongues):
    stay = np.diag(tongues.moves).mean()
    assert stay > (tongues.moves.sum() - np.trace(tongues.moves)) / (tongues.moves.size - len(tongues.labels)) + 0.5


def test_languages_of_few_or_long_texts_are_learned(spark):
    rng = random.Random(5)
    rows = [(prose(rng, "en", 40), "en") for _ in range(50)] + [(t, "de") for t in [prose(rng, "de", 40) for _ in range(3)] for _ in range(2000)]
    rows += [(prose(rng, "fr", 9000), "fr") for _ in range(3)] + [("12 !", "zz"), ("12 !", "qq")]
    field = language.learned(spark.createDataFrame(rows, "text string, lang string").repartition(7))
    assert field.labels == ["de", "en", "fr", "qq", "zz"]
    asked = spark.createDataFrame([(prose(rng, x, 30), x) for x in ("en", "de", "fr") * 5], "text string, want string")
    assert all(r["lang_pred"] == r["want"] for r in language.predicted(asked, field).collect())
    assert language.learned(spark.createDataFrame([], "text string, lang string")) is None


def test_known_tells_other_languages_and_junk(spark, tongues):
    rng = random.Random(6)
    rows = [("zxqv wkjj qqpz vbnx zzkw", 0), ("Москва столица России и большой город", 0), ("az ember és gyermek közötti különbség nagyon szép", 0), (prose(rng, "fr", 30) + " " + prose(rng, "de", 30), 1)]
    found = {r["text"]: r["known"] for r in language.predicted(spark.createDataFrame(rows, "text string, mine int"), tongues).collect()}
    assert all((found[t] >= 0.6) == bool(good) for t, good in rows), found


def test_pieces_match_the_library(spark):
    import sentencepiece

    path = sentencepiece_viterbi.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    parts = ["a", "b", "t", "h", "e", " ", "  ", "\n", "é", "ñ", "梦", "😀", "\t", "▁", "1", ".", "²", "_", "{", "<0x0A>", "</s>", "\x00", "th", "ing", "   ", "don't"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(800)] + ["", " ", "\n", "a" * 5000, " " * 3000 + "x", None]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)] + [(1, texts[1], 3)], "doc_id long, text string, ids int")
    found = sentencepiece_viterbi.encoded(docs, path).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        if r["text"] is None:
            assert r["ids"] is None and r["decoded"] is None
        else:
            assert r["ids"] == library.encode(r["text"])
            assert r["decoded"] == r["text"].replace("▁", " ")
    assert sentencepiece_viterbi.encoded(docs.limit(0), path).count() == 0


def test_unigram_pieces_have_the_largest_sum():
    pieces = {"▁": (0, -3.0), "a": (1, -2.0), "b": (2, -2.5), "ab": (3, -3.0), "aba": (4, -6.2), "▁a": (5, -2.5), "ba": (6, -3.1)}
    vocabulary = sentencepiece_viterbi.Vocabulary(pieces, [b""] * 7, 9, [], False, True)

    def best(word):
        if not word:
            return 0.0
        sums = [pieces[word[-k:]][1] + best(word[:-k]) for k in range(1, len(word) + 1) if word[-k:] in pieces]
        return max(sums, default=-1e9)

    rng = random.Random(0)
    words = sorted({"▁" + "".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(60)})
    for word, ids in sentencepiece_viterbi.encoded_words(vocabulary, words):
        assert sum(next(s for i, s in pieces.values() if i == x) for x in ids) == pytest.approx(best(word))


def test_frequent_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(sentencepiece_viterbi, "KEPT_BYTES", 60_000)
    encoded_words, encoded = sentencepiece_viterbi.encoded_words, []
    monkeypatch.setattr(sentencepiece_viterbi, "encoded_words", lambda vocabulary, words: encoded_words(vocabulary, encoded.extend(words) or words))
    pieces = {"▁": (0, -3.0), "a": (1, -2.0), "b": (2, -2.5), "ab": (3, -3.0)}

    def vocabulary():
        return sentencepiece_viterbi.Vocabulary(pieces, [b" ", b"a", b"b", b"ab"], 9, [], False, True)

    rng, one = random.Random(2), vocabulary()
    for _ in range(60):
        texts = ["abba abab ab " + " ".join("".join(rng.choices("ab", k=14)) for _ in range(40)), None]
        ids, first = sentencepiece_viterbi._encoded(one, texts)
        alone, own = sentencepiece_viterbi._encoded(vocabulary(), texts)
        assert ids.tolist() == alone.tolist() and first.tolist() == own.tolist()
        assert one.kept_bytes <= 30_000
    # 60 times by the vocabularies without memory, and once by the one with it
    assert encoded.count("▁abba") == 61


PAGE = """<html><body class="has-sidebar"><header>Site</header><div class="wrap"><div id="sidebar1"><p>Side text that is fairly long, to be left out.</p></div>
<div class="content post-12"><h1>Title &amp; more</h1><p>First  paragraph with <a href="x">a link</a> and text that is long enough.<p>Second &lt;b&gt; &#233;&nbsp;x<br>next line, also long enough.
<ul><li>one item<li>two item</ul><div class="ad">Buy!</div><script>if (a<b) "</p>"</script></div><div class="comments"><p>I disagree with all of that, very much so indeed.</p></div></div><footer>f</footer>"""


def test_main_text(spark):
    wanted = "Title & more\n\nFirst paragraph with a link and text that is long enough.\n\nSecond <b> é x next line, also long enough.\n\none item\n\ntwo item"
    # a page whose own longest part is an unmarked aside follows its host's other pages
    odd = PAGE.replace('<div class="content post-12">', '<div class="x9"><p>' + "Unmarked words of no interest go on and on here." + '</p></div><div class="content post-3">')
    rows = [(i, "http://one.example/a", PAGE) for i in range(4)] + [(4, "http://one.example/b", odd), (5, "u", None), (6, None, ""), (7, "http://two.example/", "plain text &amp; more"), (7, "http://two.example/", "plain text &amp; more"), (None, "http://one.example/a", "<p><b>un<i>closed")]
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, host int, paths string")
    found = html_text.main_text(pages).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[0] == wanted and texts[4] == wanted
    assert texts[5] == "" and texts[6] == "" and texts[7] == "plain text & more" and texts[None] == "unclosed"
    assert counted(map(tuple, html_text.main_text(pages, broadcast_bytes=0).collect())) == counted(map(tuple, found))
    for way in (0, 1 << 20):
        assert html_text.main_text(pages.limit(0), broadcast_bytes=way).count() == 0


def text_of(source):
    page = html_text.read(source)
    held, own = html_text.chain(page)
    return html_text._extracted(page, held, own, [0] * len(held)).split("\n\n")


def words(n, name):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("<body><article><h1>Head</h1><p>{0}</p><ul><li>{1}</li><li>{1}</li></ul></article></body>", ["Head", "{0}", "{1}", "{1}"]),
        ("<body><main><h1>Head</h1><div class=lead><p>{0}</p></div><div class=body><p>{1}</p></div></main></body>", ["Head", "{0}", "{1}"]),
        ("<body><h1>Head</h1><div class='text'><p>{1}</p></div><div class='x'>tiny label</div></body>", ["Head", "{1}"]),
        ("<article><p title=don't>{0}</p><p>{1}</p></article>", ["{0}", "{1}"]),
        ("<article><section class=related-work><p>{0}</p></section><p>{1}</p></article>", ["{0}", "{1}"]),
        ("<article><div class='related posts'><p>{0}</p></div><div class=ad-slot>{0}</div><div class='comment-list'>{0}</div><p class=ad-hoc>{1}</p></article>", ["{1}"]),
        ("<article><table><tr><td>{0}<td>{1}</table><blockquote>{0}</blockquote></article>", ["{0}", "{1}", "{0}"]),
        ("<div id=menu>{0}</div><div role=navigation>{0}</div><form>{0}</form><div class=post><p>{1} &lt;b&gt; a < b&nbsp; c<!-- no --> d<br>e</p></div>", ["{1} <b> a < b c d e"]),
        ("<div class=post><p>{1}</p><script>var a='<p>';</script><style>p{{}}</style><svg><p>{0}</div>", ["{1}", "{0}"]),
        ("<body><div class=content><div class=lead><p>{1}</p></div><p>A short closing paragraph of the article.</p></div></body>", ["{1}", "A short closing paragraph of the article."]),
        ("<body><form id=aspnetForm><div class=post><p>{1}</p><p>{0}</p></div></form></body>", ["{1}", "{0}"]),
        ("<body><form id=search><p>{0}</p></form><form id=aspnetForm><article><p>{1}</p></article></form></body>", ["{1}"]),
        ("<body><div class=wrapper><div class=post><p>{1}</p></div><div class=x>small label</div><p>Direct end.</p></div></body>", ["{1}", "Direct end."]),
        ("<article><div class=entry-header><h1>Head</h1></div><div class='content with-sidebar'><p>{1}</p></div></article>", ["Head", "{1}"]),
        ("<article><div class=navigation-safety><p>{0}</p></div><p>{1}</p></article>", ["{0}", "{1}"]),
    ],
)
def test_article_text_stays(source, wanted):
    given = words(6, "lead"), words(80, "body")
    assert text_of(source.format(*given)) == [w.format(*given) for w in wanted]


NOISE = "page-footer article-comments user-comments related-articles cookie-policy google-ads page-header social-media global-nav blog-sidebar entry-footer main-menu sidebar-content nav-below site-header post-comments sponsored-story newsletter-signup"


@pytest.mark.parametrize("name", NOISE.split())
def test_named_noise_goes(name):
    given = words(6, "noise"), words(80, "body")
    for place in ("class", "id"):
        source = f"<article><p>{given[1]}</p><div {place}={name}><p>{given[0]}</p></div></article>"
        assert text_of(source) == [given[1]]


def plain_choice(sources):
    """For pages (host, html): the text below the container of the page's chain that most pages of its host chose."""
    pages = [(host, html_text.read(s)) for host, s in sources]
    chains = [html_text.chain(p) for _, p in pages]
    chosen = [(h, p.path(held[own - 1])) for (h, p), (held, own) in zip(pages, chains) if own]
    out = []
    for (host, page), (held, own) in zip(pages, chains):
        ranked = sorted(((sum(c == (host, page.path(n)) for c in chosen), i) for i, n in enumerate(held)), reverse=True)
        best = ranked[0][1] if ranked and ranked[0][0] else own - 1
        out.append(html_text.text_below(page, held[best] if best >= 0 else 0))
    return out


def test_votes_by_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for i in range(120):
        parts = [f"<div class={rng.choice('abc')}{rng.randint(1, 9)}><p>{words(rng.choice([5, 60, 90]), 'w')}</p></div>" for _ in range(rng.randint(1, 4))]
        middle = f"<section class={rng.choice(['x', 'y'])}>{''.join(parts)}</section>" if rng.random() < 0.7 else "".join(parts)
        rows.append((i, f"http://h{rng.randint(0, 4)}.example/{i}", f"<body>{middle}<p>{words(3, 'end')}</p></body>"))
    wanted = dict(zip([r[0] for r in rows], plain_choice([(r[1].split("/")[2], r[2]) for r in rows])))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for way in (0, 1 << 20):
        assert {r["page_id"]: r["text"] for r in html_text.main_text(pages, broadcast_bytes=way).collect()} == wanted


def test_broken_and_deep_pages_take_linear_time():
    import time

    for source in ("if i<n then " * 90_000, "<b>" * 5 + "</i>" * 200_000, "<div class=a>" * 60_000 + "x" * 10, "<p><i>" * 100_000, '<a x="' * 150_000, "<!-- x " * 100_000, "<svg>x" * 100_000, "<script>" * 100_000, "<li><span>" * 80_000):
        began = time.time()
        html_text.read(source)
        assert time.time() - began < 4, source[:20]


def brute_top(vectors, queries, k):
    rows = []
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            rows.append((i, [int(np.floor(1024 * float(x))) for x in v]))
    out = []
    for q in sorted({i for i, _ in rows if queries(i)}):
        scored = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for j, w in rows if j == q for i, v in rows if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_rows_of_one_id_are_candidates_each(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (2, [0.5, 0.0]), (2, [9.0, 0.0]), (3, [0.75, 0.0])], "vec_id long, embedding array<float>")
    found = knn.top_k(table, F.col("vec_id") == 0, 10).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found) == [(1, 2, 9 * 1024 * 1024), (2, 3, 768 * 1024), (3, 2, 512 * 1024)]


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k(spark, block):
    rng = np.random.default_rng(6)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(150)] + [(i, [1.0, 0.5, -0.25, 0.0]) for i in range(150, 200)]
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan"), 0.0, 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0, 0.0]), (304, []), (305, [2.0]), (None, [9.0, 9.0, 9.0, 9.0]), (20, [float(x) for x in vectors[20][1]])]
    table = spark.createDataFrame([(i, v, 1, "k") for i, v in vectors], "vec_id long, embedding array<float>, v int, cell string").repartition(3)
    found = knn.top_k(table, F.col("vec_id") % 10 == 0, 10, block=block).collect()
    assert sorted(tuple(r) for r in found) == brute_top(vectors, lambda i: i % 10 == 0, 10)
    few = knn.top_k(table.filter("vec_id < 5"), F.col("vec_id") % 2 == 0, 10).collect()
    assert sorted(tuple(r) for r in few) == brute_top(vectors[:5], lambda i: i % 2 == 0, 10)
    assert knn.top_k(table.limit(0), F.col("vec_id") % 2 == 0, 10).count() == 0
