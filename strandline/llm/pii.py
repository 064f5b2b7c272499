"""Personal data: fixed kinds by pattern, and unseen identifiers by bootstrapped contexts.

Fixed kinds are e-mail, IP, card and phone numbers, as leftmost matches with the checks of their kind. They are the
seeds, with tokens of one more kind, secret: 32 or more letters and digits. Every identifier-like token (an @, or four
digits) is an instance, and the words before it are its lexical patterns: the last word, and the last two. A pattern can
discover identifiers only if it has LEAST_SUPPORT distinct instances and if LEAST_SPECIFIC of all places where its words
stand in the corpus are followed by an instance, which words of ordinary prose never reach.

The graph of those patterns and their instances is scored in rounds. A seed's score is 1. A pattern's confidence is the
mean score of its distinct instances; with LEAST_CONFIDENCE, and LEAST_SEEDS instances that have a score, it is taken. The
instances of taken patterns get a score of their own, by all their patterns' confidence, and so induce patterns in the
next round, until no pattern is added. What follows a taken pattern becomes a span of the pattern's kind.

Everything is DataFrame and SQL functions. Graph and corpus counts are summed before they are shuffled; texts are not
shuffled unless what was found is too much to broadcast. Positions are running sums of the lengths of gaps and matches,
in two levels, so a text with many of them takes time in proportion to its length.

Defined cases: a null text is an empty one and has no spans; a very long text is read whole; of kinds with equal scores
the last by name is taken, and of overlapping spans all are listed; repeated rows get equal results; other columns are
not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import written

# Runs are possessive and begin at a run's first character (or where the match before ended). That finds the same
# matches as the plain patterns of the kinds without trying every start in a long run.
_LOCAL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"
#: Fixed value: marks around a token that are not part of an identifier.
TRIM = r"""["'`.,;:!?()\[\]{}<>|*#$%&=]*"""
#: A seed of the kind secret.
SECRET = "^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{32,}$"
#: Kinds of spans: the fixed ones, and what contexts may discover besides.
FOUND_KINDS = (*KINDS, "secret")
LEAST_CONFIDENCE = 0.3
LEAST_SUPPORT = 5
LEAST_SEEDS = 3
LEAST_SPECIFIC = 0.5

#: Found spans, or patterns, up to which a broadcast is used; beyond that both sides are shuffled.
BROADCAST_ROWS = 500_000
#: Elements of one step of a running sum.
CHUNK = 256

SPANS = "array<struct<start:bigint,end:bigint>>"
TOKENS = "array<struct<start:bigint,end:bigint,token:string,one:string,two:string>>"
FOUND = "array<struct<kind:string,start:bigint,end:bigint>>"


def _good(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        doubled = F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))
        each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(F.reverse(digits), i, F.lit(1)).cast("int"))
        total = F.aggregate(F.transform(each, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.get(doubled, d))), F.lit(0), lambda a, d: a + d)
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _checked(kind: str):
    return lambda x: _good(kind, x["match"])


def _let(value: Column, body) -> Column:
    """body(value), value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, add=lambda a, b: a + b) -> Column:
    """For each of an array of bigint the sum (or what add gives) of those before it, from 0: within chunks, then over the
    chunks' totals."""
    zero = F.lit(0).cast("bigint")
    none = lambda: F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))

    def through(part: Column, value=lambda x: x) -> Column:
        return F.aggregate(part, none(), lambda done, x: F.struct(add(done["at"], value(x)).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")))

    def chunked(v: Column) -> Column:
        heads = F.sequence(F.lit(0), F.call_function("div", F.size(v) - 1, F.lit(CHUNK)).cast("int"))
        parts = F.transform(heads, lambda i: through(F.slice(v, i * CHUNK + 1, F.lit(CHUNK))))
        return _let(parts, lambda p: F.flatten(F.zip_with(p, through(p, lambda x: x["at"])["out"], lambda x, top: F.transform(x["out"], lambda y: add(top, y)))))

    return _let(values, lambda v: F.when(F.size(v) > 0, chunked(v)).otherwise(F.array().cast("array<bigint>")))


def _placed(text: Column, pattern: str) -> Column:
    """Array of structs start, end, match over all matches. start and end count code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def measured(m: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(m))
        return F.zip_with(gaps, m, lambda g, x: F.struct(F.char_length(g).cast("bigint").alias("gap"), F.char_length(x).cast("bigint").alias("long"), x.alias("match")))

    def spans(pairs: Column) -> Column:
        before = _running(F.transform(pairs, lambda p: p["gap"] + p["long"]))
        return F.zip_with(pairs, before, lambda p, at: F.struct((at + p["gap"]).alias("start"), (at + p["gap"] + p["long"]).alias("end"), p["match"].alias("match")))

    return _let(_let(found, measured), spans)


def fixed_kinds(text: Column) -> dict[str, Column]:
    """For each fixed kind, an array of structs start, end."""
    out = {}
    for kind, pattern in KINDS.items():
        good = F.filter(_placed(text, pattern), _checked(kind))
        spans = F.transform(good, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
        need = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike("[0-9]")
        out[kind] = F.when(need, spans).otherwise(F.array().cast(SPANS))
    return out


def _identifier(token: Column) -> Column:
    return F.contains(token, F.lit("@")) | (F.length(F.regexp_replace(token, "[^0-9]", "")) >= 4)


def scanned(docs: DataFrame) -> DataFrame:
    """docs, tag (a hash of the text), the spans of each fixed kind, and tokens that look like identifiers."""
    text = F.coalesce("text", F.lit(""))

    def identifiers(w: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: _identifier(F.get(w, i)["match"]))

        def token(i: Column) -> Column:
            own = F.get(w, i)
            before = F.char_length(F.regexp_extract(own["match"], f"^{TRIM}", 0))
            core = F.regexp_replace(F.regexp_replace(own["match"], f"^{TRIM}", ""), f"(?<![\"'`.,;:!?()\\[\\]{{}}<>|*#$%&=]){TRIM}$", "")
            word = lambda k: F.lower(F.coalesce(F.get(w, i - k)["match"], F.lit("")))
            return F.struct(
                (own["start"] + before).cast("bigint").alias("start"),
                (own["start"] + before + F.char_length(core)).cast("bigint").alias("end"),
                core.alias("token"),
                word(1).alias("one"),
                F.when(i >= 2, F.concat_ws(" ", word(2), word(1))).otherwise(F.lit("")).alias("two"),
            )

        return F.transform(at, token)

    tokens = F.when(text.rlike("[0-9@]"), _let(_placed(text, r"\S+"), identifiers)).otherwise(F.array().cast(TOKENS))
    rows = docs.select("*", F.xxhash64("text").alias("tag"), *[c.alias(k) for k, c in fixed_kinds(text).items()], tokens.alias("tokens"))
    return rows.withColumn("seeds", F.when(F.size("tokens") > 0, F.arrays_zip(*[_touched("tokens", kind).alias(kind) for kind in KINDS])))


def _touched(tokens: str, kind: str) -> Column:
    """For each of tokens whether a span of the kind overlaps it; both are sorted, and neither overlaps itself."""
    far = F.lit(2**40)
    event = lambda x, what: F.struct(x["start"].alias("start"), F.lit(what).alias("what"), x["end"].alias("end"))
    both = F.array_sort(F.concat(F.transform(kind, lambda x: event(x, 0)), F.transform(tokens, lambda x: event(x, 1))))

    def marked(e: Column) -> Column:
        # of the spans that begin before or with a token the largest end; of those that begin later the smallest start
        ends = _running(F.transform(e, lambda x: F.when(x["what"] == 0, x["end"]).otherwise(F.lit(0).cast("bigint"))), F.greatest)
        starts = F.reverse(_running(F.transform(F.reverse(e), lambda x: F.when(x["what"] == 0, far - x["start"]).otherwise(F.lit(0).cast("bigint"))), F.greatest))
        seen = F.zip_with(F.zip_with(e, ends, lambda x, end: F.struct(x.alias("x"), end.alias("end"))), starts, lambda y, start: F.struct(
            (y["x"]["what"] == 1).alias("token"), ((y["end"] > y["x"]["start"]) | (far - start < y["x"]["end"])).alias("hit")
        ))
        return F.transform(F.filter(seen, lambda y: y["token"]), lambda y: y["hit"])

    return F.when(F.size(kind) > 0, _let(both, marked)).otherwise(F.transform(tokens, lambda _: F.lit(False)))


def occurrences(scan: DataFrame) -> DataFrame:
    """A row for each identifier-like token and pattern: doc_id, tag, start, end, token, pattern, seed (its kind or null)."""
    found = scan.select("doc_id", "tag", F.explode(F.arrays_zip("tokens", "seeds")).alias("t")).select("doc_id", "tag", "t.tokens.*", "t.seeds").filter("token <> ''")
    seed = F.coalesce(*[F.when(F.col("seeds")[kind], F.lit(kind)) for kind in KINDS], F.when(F.col("token").rlike(SECRET), F.lit("secret")))
    rows = found.select("doc_id", "tag", "start", "end", "token", seed.alias("seed"), F.explode(F.array("one", "two")).alias("pattern"))
    return rows.filter("pattern <> ''")


def specific_patterns(docs: DataFrame, seen: DataFrame, least: float = LEAST_SPECIFIC) -> DataFrame:
    """pattern: those with LEAST_SUPPORT distinct instances of which, over all their places in the corpus, least are
    followed by an instance."""
    support = seen.groupBy("pattern", "token").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern").agg(F.count(F.lit(1)).alias("support"), F.sum("n").alias("followed"))
    may = written(support.filter(F.col("support") >= LEAST_SUPPORT))
    few = may.count() <= BROADCAST_ROWS
    words = F.split(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))), " ")
    pairs = F.zip_with(F.col("w"), F.concat(F.array(F.lit("")), F.col("w")), lambda a, b: F.struct(a.alias("one"), b.alias("before")))
    places = docs.select(words.alias("w")).select(F.explode(pairs).alias("p")).select("p.one", "p.before", F.lit(1).cast("bigint").alias("n")).filter("one IS NOT NULL")
    if few:
        last = may.select(F.element_at(F.split("pattern", " "), -1).alias("one")).distinct()
        places = places.join(F.broadcast(last), "one", "left_semi")
    else:  # every pair of words once, with its count
        places = places.groupBy("one", "before").agg(F.sum("n").alias("n"))
    both = places.select(F.explode(F.array(F.col("one"), F.when(F.col("before") != "", F.concat_ws(" ", "before", "one")))).alias("pattern"), "n").filter("pattern IS NOT NULL")
    names = may.select("pattern")
    total = both.join(F.broadcast(names) if few else names, "pattern", "left_semi").groupBy("pattern").agg(F.sum("n").alias("places"))
    return may.join(total, "pattern").filter(F.col("followed") >= least * F.col("places")).select("pattern")


def taken_patterns(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """pattern, kind, confidence of the patterns that discover identifiers."""
    good = specific_patterns(docs, seen)
    edges = written(seen.join(good, "pattern", "left_semi").groupBy("pattern", "token").agg(F.max("seed").alias("seed")))
    seeds = edges.filter("seed IS NOT NULL").groupBy("token").agg(F.max("seed").alias("kind")).withColumn("score", F.lit(1.0))
    instances, taken, count = seeds, None, -1
    while True:
        weighed = edges.join(instances, "token", "left")
        kinds = weighed.groupBy("pattern", "kind").agg(F.sum("score").alias("of_kind"), F.count(F.lit(1)).alias("n"))
        patterns = kinds.groupBy("pattern").agg(
            (F.coalesce(F.sum("of_kind"), F.lit(0.0)) / F.sum("n")).alias("confidence"),
            F.sum(F.when(F.col("kind").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
            F.max_by("kind", F.when(F.col("kind").isNotNull(), F.struct("of_kind", "kind"))).alias("kind"),
        )
        # scores only grow, so a taken pattern stays and the rounds end
        taken = written(patterns.filter((F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("known") >= LEAST_SEEDS)).select("pattern", "kind", "confidence"))
        now = taken.count()
        if now == count or not now:
            return taken
        count = now
        reached = edges.filter("seed IS NULL").join(taken, "pattern").groupBy("token").agg(
            F.max_by("kind", F.struct("confidence", "kind")).alias("kind"), (1 - F.exp(F.sum(F.log(1.000000001 - F.col("confidence"))))).alias("score")
        )
        instances = seeds.unionByName(reached.join(seeds, "token", "left_anti"))


def discovered(docs: DataFrame, scan: DataFrame) -> DataFrame:
    """_id, _tag, found: the spans of contexts for each text that has any, broadcast if they are few."""
    seen = written(occurrences(scan))
    fresh = seen.filter(F.col("seed").isNull() | (F.col("seed") == "secret")).join(taken_patterns(docs, seen), "pattern")
    best = fresh.groupBy("doc_id", "tag", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    found = best.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("found"))
    found = written(found)
    spans = found.agg(F.sum(F.size("found"))).first()[0] or 0
    return F.broadcast(found) if spans <= BROADCAST_ROWS else found


def _with_found(docs: DataFrame, scan: DataFrame) -> DataFrame:
    found = discovered(docs, scan)
    joined = scan.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    return joined.withColumn("found", F.coalesce("found", F.array().cast(FOUND))).drop("_id", "_tag", "tokens", "seeds")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tag, one array of spans (start, end) for each fixed kind, and found: spans (kind, start, end) of the contexts."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _with_found(docs, written(scanned(docs).drop("text")))


def _names(kind: str, spans: Column) -> Column:
    return F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))


def _listed(spans: dict[str, Column]) -> Column:
    """kind:start:end, by kind as listed, then start, comma-joined."""
    return F.array_join(F.concat(*[_names(kind, s) for kind, s in spans.items()]), ",")


def _of_kind(kind: str) -> Column:
    own = F.filter("found", lambda x: x["kind"] == kind)
    return F.transform(own, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def _replaced(body: Column, spans: Column) -> Column:
    """body with each of spans (start, end, kind; sorted) replaced by its kind; overlapping ones become one."""
    ends = _running(F.transform(spans, lambda x: x["end"]), F.greatest)

    def text(wide: Column, a: Column, b: Column) -> Column:
        # four bytes a code point: a piece is found without reading what stands before it
        return F.decode(F.substring(wide, (4 * a + 1).cast("int"), (4 * (b - a)).cast("int")), "UTF-32")

    def pieces(wide: Column) -> Column:
        own = F.zip_with(spans, ends, lambda x, at: F.when(x["start"] >= at, F.concat(text(wide, at, x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit("")))
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(own, ""), text(wide, last, F.char_length(body).cast("bigint")))

    return _let(F.encode(body, "UTF-32"), pieces)


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with every span of personal data in text replaced by its kind in angle brackets; overlapping spans become
    one. Other columns stay as they are."""
    rest = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]).alias("row"))
    scan = written(scanned(rest))
    joined = _with_found(rest.select("doc_id", "text"), scan)
    spans = F.array_sort(F.concat(*[_with_kind(kind) for kind in KINDS], F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    clean = joined.select("row", "text", spans.alias("spans")).select("row", F.when(F.size("spans") > 0, _replaced(F.col("text"), F.col("spans"))).otherwise(F.col("text")).alias("text"))
    return clean.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _with_kind(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def op1_bootstrapped_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = {kind: F.col(kind) for kind in KINDS}
    everything = {kind: F.array_distinct(F.concat(F.col(kind), _of_kind(kind))) if kind in KINDS else _of_kind(kind) for kind in FOUND_KINDS}
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(everything).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )
