"""Benchmark decontamination by winnowing.

Of every run of w consecutive k-grams the smallest hash is kept, in documents and benchmark items alike, so any shared
span of k + w - 1 words has a common fingerprint at a common place. With k + w - 1 equal to the window (10 words, or all
words of a shorter item) no shared window is missed. Fingerprints of documents are joined with those of the benchmark,
and each hit is extended to the windows around it, which must agree as a whole.

Two ways for the join, by the measured number of benchmark windows: up to BROADCAST_WINDOWS the index is sent to all
tasks as sorted arrays; beyond that both sides are shuffled by fingerprint, then by window.

Words are equal if their 64-bit fingerprints are, and windows if theirs are: two different windows out of n share one with
odds of n / 2 ** 64 for each window they are held against.

Defined cases: null and wordless texts hit nothing; a very long text is read whole; of k-grams with equal hashes all are
kept; rows of an item id count as one item; a null item id is an item named by the empty string; items with equal windows
are all listed; repeated documents get equal results; an empty benchmark leaves every document clean, and an empty table
gives no rows; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ALNUM, LOWER, Words, column, extended, slices, words_of, written

WINDOW = 10
#: Windows of the whole benchmark that a broadcast index may hold: 24 bytes each and the item names.
BROADCAST_WINDOWS = 500_000


def _grams(window: int) -> tuple[int, int]:
    """k and w with k + w - 1 = window."""
    k = (window + 1) // 2
    return k, window - k + 1


def winnowed(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the k-grams that are smallest in a run of w k-grams of one text (all of them at ties)."""
    k, w = _grams(window)
    at, grams = words.windows(k)
    if not len(at):
        return at, grams
    runs = np.flatnonzero(np.arange(len(at)) + w - 1 < len(at))
    runs = runs[at[runs + w - 1] == at[runs] + w - 1]
    text = np.searchsorted(words.first, at, side="right")
    runs = runs[text[runs] == text[runs + w - 1]]
    least = grams[runs]
    for j in range(1, w):
        least = np.minimum(least, grams[runs + j])
    chosen = np.zeros(len(at), dtype=bool)
    for j in range(w):
        chosen[runs[grams[runs + j] == least] + j] = True
    return at[chosen], grams[chosen]


def item_index(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """length, kind, print, item: distinct fingerprints (kind 0, without an item) and windows (kind 1) of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), ALNUM, LOWER)
                n = words.counts()
                names = column(part, "item").to_pylist()
                for length in np.unique(np.minimum(n[n > 0], window)).tolist():
                    rows = np.minimum(n, window) == length
                    for kind, (at, prints) in enumerate((winnowed(words, length), words.windows(length))):
                        text_no = np.searchsorted(words.first, at, side="right") - 1
                        keep = rows[text_no]
                        owners = [names[t] if kind else "" for t in text_no[keep].tolist()]
                        m = int(keep.sum())
                        columns = [pa.array([length] * m, pa.int32()), pa.array([kind] * m, pa.int32()), pa.array(prints[keep].view(np.int64)), pa.array(owners, pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, ["length", "kind", "print", "item"])

    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return named.mapInArrow(run, "length int, kind int, print long, item string").distinct()


def _candidates(words: Words, length: int, hits: np.ndarray) -> np.ndarray:
    """Starts of the windows of length words that hold a hit's k-gram and stay in its text."""
    k, _ = _grams(length)
    text_no = np.searchsorted(words.first, hits, side="right") - 1
    lo = np.maximum(hits - (length - k), words.first[text_no])
    hi = np.minimum(hits, words.first[text_no + 1] - length)
    good = lo <= hi
    change = np.zeros(len(words.hashes) + 1, dtype=np.int32)
    np.add.at(change, lo[good], 1)
    np.add.at(change, hi[good] + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:-1] > 0)


def _among(sorted_prints: np.ndarray, prints: np.ndarray) -> np.ndarray:
    if not len(sorted_prints):
        return np.zeros(len(prints), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_prints, prints), len(sorted_prints) - 1)
    return sorted_prints[at] == prints


RESULT = ["n_words", "n_hit", "n_items", "items", "hit_at"]
RESULT_TYPES = "n_words long, n_hit long, n_items long, items array<string>, hit_at binary"


def _by_broadcast(docs: DataFrame, index: DataFrame) -> DataFrame:
    rows = index.toPandas()  # BROADCAST_WINDOWS rows of either kind at most
    found: dict[int, list] = {}
    for length, own in rows.groupby("length"):
        grams = np.sort(own.loc[own["kind"] == 0, "print"].to_numpy().view(np.uint64))
        windows = own[own["kind"] == 1]
        prints = windows["print"].to_numpy().view(np.uint64)
        order = np.argsort(prints, kind="stable")
        found[int(length)] = [grams, prints[order], windows["item"].to_numpy()[order]]
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), ALNUM, LOWER)
                covered = np.zeros(len(words.hashes) + 1, dtype=np.int32)
                items: dict[int, set[str]] = {}
                for length, (grams, prints, owners) in shared.value.items():
                    at, own = winnowed(words, length)
                    starts = _candidates(words, length, at[_among(grams, own)])
                    whole = words.window_hashes(starts, length)
                    same = _among(prints, whole)
                    starts, whole = starts[same], whole[same]
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + length, -1)
                    text_no = np.searchsorted(words.first, starts, side="right") - 1
                    pairs = np.unique(np.stack((text_no.astype(np.uint64), whole)), axis=1) if len(starts) else np.zeros((2, 0), dtype=np.uint64)
                    lo, hi = np.searchsorted(prints, pairs[1]), np.searchsorted(prints, pairs[1], side="right")
                    for t, a, b in zip(pairs[0].tolist(), lo.tolist(), hi.tolist(), strict=True):
                        items.setdefault(t, set()).update(owners[a:b])
                hit = np.cumsum(covered)[:-1] > 0
                total = np.concatenate(([0], np.cumsum(hit)))
                n_hit = total[words.first[1:]] - total[words.first[:-1]]
                lists, at = [], []
                for t in range(len(part)):
                    lists.append(sorted(items.get(t, ())))
                    at.append(np.flatnonzero(hit[words.first[t] : words.first[t + 1]]).astype(np.int32).tobytes() if n_hit[t] else b"")
                columns = [
                    *part.columns,
                    pa.array(words.counts().astype(np.int64)),
                    pa.array(n_hit.astype(np.int64)),
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array(lists, pa.list_(pa.string())),
                    pa.array(at, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *RESULT])

    return docs.mapInArrow(run, extended(docs, RESULT_TYPES))


def _by_shuffle(docs: DataFrame, index: DataFrame) -> DataFrame:
    lengths = [row[0] for row in index.select("length").distinct().collect()]  # 1 to WINDOW
    names = docs.columns
    plain, docs = docs, docs.withColumn("_tag", F.xxhash64("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), ALNUM, LOWER)
                tags = column(part, "_tag").to_numpy(zero_copy_only=False)
                for length in lengths:
                    at, own = winnowed(words, length)
                    t = np.searchsorted(words.first, at, side="right") - 1
                    columns = [pa.array(tags[t]), pa.array(np.full(len(at), length, np.int32)), pa.array((at - words.first[t]).astype(np.int64)), pa.array(own.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["_tag", "length", "at", "print"])

    probes = docs.select("_tag", "text").dropDuplicates(["_tag"]).mapInArrow(grams, "_tag long, length int, at long, print long")
    known = index.filter("kind = 0").select("length", "print")
    hits = probes.join(known, ["length", "print"], "left_semi").groupBy("_tag").agg(F.collect_set(F.struct("length", "at")).alias("hits"))
    near = docs.select("_tag", "text").dropDuplicates(["_tag"]).join(hits, "_tag")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), ALNUM, LOWER)
                tags = column(part, "_tag").to_numpy(zero_copy_only=False)
                hits = column(part, "hits").to_pylist()
                for length in lengths:
                    at = [words.first[t] + h["at"] for t, own in enumerate(hits) for h in own if h["length"] == length]
                    starts = _candidates(words, length, np.array(at, dtype=np.int64))
                    t = np.searchsorted(words.first, starts, side="right") - 1
                    own = words.window_hashes(starts, length)
                    columns = [pa.array(tags[t]), pa.array(np.full(len(t), length, np.int32)), pa.array((starts - words.first[t]).astype(np.int64)), pa.array(own.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["_tag", "length", "at", "print"])

    owned = index.filter("kind = 1").select("length", "print", "item")
    candidates = near.mapInArrow(windows, "_tag long, length int, at long, print long")
    true_hits = candidates.join(owned.select("length", "print").distinct(), ["length", "print"], "left_semi")
    places = true_hits.groupBy("_tag").agg(F.collect_set(F.struct("at", "length")).alias("_places"))
    items = true_hits.select("_tag", "length", "print").distinct().join(owned, ["length", "print"]).groupBy("_tag").agg(F.collect_set("item").alias("_items"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), ALNUM, LOWER)
                n = words.counts()
                hit, at = [], []
                for t, own in enumerate(column(part, "_places").to_pylist()):
                    mask = np.zeros(n[t], dtype=bool)
                    for p in own or ():
                        mask[p["at"] : p["at"] + p["length"]] = True
                    hit.append(int(mask.sum()))
                    at.append(np.flatnonzero(mask).astype(np.int32).tobytes())
                lists = [sorted(x or ()) for x in column(part, "_items").to_pylist()]
                columns = [*(column(part, c) for c in names), pa.array(n.astype(np.int64)), pa.array(hit, pa.int64()), pa.array([len(x) for x in lists], pa.int64()), pa.array(lists, pa.list_(pa.string())), pa.array(at, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*names, *RESULT])

    found = docs.join(places, "_tag", "left").join(items, "_tag", "left").drop("_tag")
    return found.mapInArrow(counted, extended(plain, RESULT_TYPES))


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """docs with n_words, n_hit, n_items, items (sorted ids) and hit_at (places of hit words, 32-bit); columns of these
    names are replaced."""
    kept = [c for c in docs.columns if c not in RESULT]
    # the other columns travel as one, so that none of their names matters
    packed = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in kept if c != text] or [F.lit(0).alias("none")]).alias("row"))
    index = written(item_index(items, window))
    found = (_by_broadcast if index.count() <= broadcast_windows else _by_shuffle)(packed, index)
    return found.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in kept], *RESULT)


def op2_winnowing(spark, sf_dir: str) -> DataFrame:
    """Hits of every benchmark item in every document."""
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH letters AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low
), docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), up, low), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents, letters
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), up, low), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark, letters
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)
), hits AS (
  SELECT doc_id, i, doc_windows.m AS m, item_id FROM doc_windows JOIN item_windows ON doc_windows.s = item_windows.s AND doc_windows.m = item_windows.m
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
