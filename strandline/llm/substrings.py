"""Repeated passages across documents, found over fixed blocks.

A passage of 13 words holds a whole block of 7 words that starts at a multiple of 7, wherever it starts. So the blocks
of all documents are the index, every rolling window of 7 words probes it, and blocks that another document's window
hits are extended: the 13-word windows around them are looked up the same way, by all their words. Both documents of a
shared passage have a block of their own in it, hit by the other. What a window's first document (smallest id) keeps, later
documents lose; overlapping windows make up the maximal repeats.

Index and probes travel packed: one row holds what a few hundred documents have in one hash bucket, as arrays of
fingerprints and positions, so a row's fixed cost is shared. The number of buckets follows the bytes of text.

Common passages do not travel: 7-word windows that HOT of a sample of about SAMPLE documents have are known to be shared,
and of the 13-word windows that consist of such only, one pass sums up the smallest document of each, which is exact and
small enough for every task to hold. So no bucket's size follows the number of documents that hold one passage. The
sample decides what travels, never what is found.

Words are equal if their 64-bit fingerprints are; two different windows of a corpus of n windows share one with odds of
n * n / 2 ** 65.

Defined cases: null and short texts have no windows and lose nothing; a very long text is read whole; rows with one id
are one document's, which never lose to each other; a null id counts as the largest, and such rows do not lose to each
other; repeated rows get equal results; other columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import NONSPACE, Words, column, slices, words_of

WINDOW = 13
#: Text that one bucket stands for.
BUCKET_BYTES = 24_000_000
LEAST_BUCKETS = 24
#: Compressed text that one numpy step takes.
PACKED_BYTES = 800_000
LAST_ID = np.iinfo(np.int64).max
#: Documents (about) whose windows are counted, and how many of them must have a window that is not to travel.
SAMPLE = 8_000
HOT = 8
#: Common windows that every task may hold. With more than that all travel.
MOST_HOT = 1_000_000

PACKED = "bucket int, ids binary, tags binary, counts binary, low binary, high binary, prints binary"


def buckets_for(docs: DataFrame, text: str) -> int:
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(LEAST_BUCKETS, int(total // BUCKET_BYTES))


def _packed(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, at: np.ndarray, prints: np.ndarray, buckets: int, kind: type) -> Iterator[tuple]:
    """Rows of PACKED: entries (document, position, fingerprint) by bucket, in order of document and position."""
    bucket = ((prints >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint32)
    order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[b] : cuts[b + 1]]
        d = doc[own]
        heads = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        where = at[own].astype(np.uint32)
        counts = np.diff(np.concatenate((heads, [len(d)]))).astype(np.int32)
        yield (
            b,
            ids[d[heads]].tobytes(),
            tags[d[heads]].tobytes(),
            counts.tobytes(),
            (where & 0xFFFF).astype(np.uint16).tobytes(),
            (where >> 16).astype(np.uint16).tobytes(),
            prints[own].astype(kind).tobytes(),
        )


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    names = ["bucket", "ids", "tags", "counts", "low", "high", "prints"]
    parts = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(parts[0], pa.int32())] + [pa.array(x, pa.binary()) for x in parts[1:]], names)


def _ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = column(part, "doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
    return ids.astype(np.int64), column(part, "tag").to_numpy(zero_copy_only=False).astype(np.int64)


def _in_text(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.searchsorted(words.first, at, side="right") - 1
    return doc, at - words.first[doc]


def probes(docs: DataFrame, buckets: int, window: int, hot: Broadcast) -> DataFrame:
    """Rolling windows of half a window's words, but for common ones, packed. Those at multiples of their length are the
    reference blocks."""
    block = (window + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), NONSPACE)
                at, prints = words.windows(block)
                doc, place = _in_text(words, at)
                keep = (words.counts()[doc] >= window) & ~_among(hot.value.blocks, prints)
                if keep.any():
                    ids, tags = _ids(part)
                    yield _batch_of(list(_packed(ids, tags, doc[keep], place[keep], prints[keep], buckets, np.uint32)))

    return docs.mapInArrow(run, PACKED)


@dataclass
class Hot:
    """Ascending fingerprints of common windows of half a window's words, and of whole windows that consist of such, with
    the smallest document of each."""

    blocks: np.ndarray
    windows: np.ndarray
    first: np.ndarray


def _among(known: np.ndarray, prints: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(prints), dtype=bool)
    return known[np.minimum(np.searchsorted(known, prints), len(known) - 1)] == prints


def _whole_hot(words: Words, blocks: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether the block that starts there is common, and where windows of common blocks only start."""
    block = (window + 1) // 2
    at, prints = words.windows(block)
    common = np.zeros(len(words.hashes) + 1, dtype=bool)
    common[at] = _among(blocks, prints)
    through = np.concatenate(([0], np.cumsum(common)))
    last = np.repeat(words.first[1:], words.counts())
    starts = np.flatnonzero(common[:-1] & (np.arange(len(words.hashes)) + window <= last))
    inside = window - block + 1
    return common, starts[through[starts + inside] - through[starts] == inside]


def hot_windows(docs: DataFrame, window: int) -> Hot:
    """docs: doc_id, tag, text."""
    block = (window + 1) // 2
    every = max(1, docs.count() // SAMPLE)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), NONSPACE)
                at, prints = words.windows(block)
                doc = np.searchsorted(words.first, at, side="right") - 1
                order = np.lexsort((prints, doc))
                doc, prints = doc[order], prints[order]
                new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (prints[1:] != prints[:-1])))[: len(prints)]
                ids, _ = _ids(part)
                yield pa.RecordBatch.from_arrays([pa.array(prints[new].view(np.int64)), pa.array(ids[doc[new]])], ["print", "id"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "tag"), F.lit(every)) == 0).mapInArrow(counted, "print long, id long")
    common = sample.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter((F.col("n") >= HOT) & (F.col("a") < F.col("b")))
    none = np.zeros(0, dtype=np.uint64)
    # fewer than SAMPLE / HOT times the windows of one document
    blocks = common.select("print").limit(MOST_HOT + 1).toPandas()["print"].to_numpy(dtype=np.int64).view(np.uint64)
    if not 0 < len(blocks) <= MOST_HOT:
        return Hot(none, none, none.astype(np.int64))
    blocks = np.sort(blocks)
    shared = docs.sparkSession.sparkContext.broadcast(blocks)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(column(part, "text"), NONSPACE)
                _, at = _whole_hot(words, shared.value, window)
                ids, _ = _ids(part)
                prints, own = words.window_hashes(at, window), ids[np.searchsorted(words.first, at, side="right") - 1]
                order = np.lexsort((own, prints))
                prints, own = prints[order], own[order]
                new = np.concatenate(([True], prints[1:] != prints[:-1]))[: len(prints)]
                yield pa.RecordBatch.from_arrays([pa.array(prints[new].view(np.int64)), pa.array(own[new])], ["print", "id"])

    least = docs.mapInArrow(firsts, "print long, id long").groupBy("print").agg(F.min("id").alias("id")).limit(MOST_HOT + 1).toPandas()
    if len(least) > MOST_HOT:
        return Hot(none, none, none.astype(np.int64))
    prints = least["print"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(prints)
    return Hot(blocks, prints[order], least["id"].to_numpy(dtype=np.int64)[order])


def around_hits(docs: DataFrame, buckets: int, window: int, hot: Broadcast) -> DataFrame:
    """Whole windows around the hits of each row (places: packed positions) and around its common blocks, packed. Windows
    of common blocks only are left out."""
    block = (window + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "packed", PACKED_BYTES):
                words = words_of(unsqueezed(part), NONSPACE)
                change = np.zeros(len(words.hashes) + 1, dtype=np.int32)
                n = words.counts()
                common, whole = _whole_hot(words, hot.value.blocks, window)
                own = np.flatnonzero(common)
                own_text, own_place = _in_text(words, own)
                anchors = own_place % block == 0
                own_text, own_place = own_text[anchors], own_place[anchors]
                cuts = np.searchsorted(own_text, np.arange(len(part) + 1))
                for t, places in enumerate(column(part, "places").to_pylist()):
                    hits = own_place[cuts[t] : cuts[t + 1]]
                    if places:
                        hits = np.concatenate((hits, np.frombuffer(b"".join(places), dtype=np.uint32).astype(np.int64)))
                    if len(hits):
                        lo = np.maximum(hits - (window - block), 0)
                        hi = np.minimum(hits, n[t] - window)
                        good = lo <= hi
                        np.add.at(change, words.first[t] + lo[good], 1)
                        np.add.at(change, words.first[t] + hi[good] + 1, -1)
                wanted = np.cumsum(change)[:-1] > 0
                wanted[whole] = False
                at = np.flatnonzero(wanted)
                if len(at):
                    ids, tags = _ids(part)
                    doc, place = _in_text(words, at)
                    yield _batch_of(list(_packed(ids, tags, doc, place, words.window_hashes(at, window), buckets, np.uint64)))

    return docs.mapInArrow(run, PACKED)


def _unpacked(rows: pd.DataFrame, kind: type) -> tuple[np.ndarray, ...]:
    """Of all entries of a bucket: document ids, tags (by document), documents' numbers, positions, fingerprints."""
    ids = np.frombuffer(b"".join(rows["ids"]), dtype=np.int64)
    tags = np.frombuffer(b"".join(rows["tags"]), dtype=np.int64)
    counts = np.frombuffer(b"".join(rows["counts"]), dtype=np.int32)
    doc = np.repeat(np.arange(len(ids), dtype=np.uint32), counts)
    low = np.frombuffer(b"".join(rows["low"]), dtype=np.uint16)
    high = np.frombuffer(b"".join(rows["high"]), dtype=np.uint16)
    return ids, tags, doc, low.astype(np.uint32) | (high.astype(np.uint32) << np.uint32(16)), np.frombuffer(b"".join(rows["prints"]), dtype=kind)


def _by_document(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> pd.DataFrame:
    """Chosen entries (in order of document) as one row for each document."""
    if not len(chosen):
        return pd.DataFrame({"doc_id": ids[:0], "tag": tags[:0], "place": np.zeros(0, dtype=object)})
    d = doc[chosen]
    heads = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
    ends = np.concatenate((heads[1:], [len(d)]))
    where = at[chosen]
    places = [where[a:b].tobytes() for a, b in zip(heads.tolist(), ends.tolist(), strict=True)]
    return pd.DataFrame({"doc_id": ids[d[heads]], "tag": tags[d[heads]], "place": places})


def _by_print(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(prints, kind="stable")
    ordered = prints[order]
    return order, np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


FOUND = "doc_id long, tag long, place binary"


def shared_blocks(packed: DataFrame, window: int) -> DataFrame:
    """Reference blocks whose words also stand, at any position, in another document."""
    block = (window + 1) // 2

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, tags, doc, at, prints = _unpacked(rows, np.uint32)
        order, heads = _by_print(prints)
        own = ids[doc[order]]
        sizes = np.diff(np.concatenate((heads, [len(order)])))
        live = np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads)
        chosen = np.sort(order[np.repeat(live, sizes) & (at[order] % block == 0)])
        return _by_document(ids, tags, doc, at, chosen)

    return packed.groupBy("bucket").applyInPandas(run, FOUND)


def later_windows(packed: DataFrame) -> DataFrame:
    """Positions of windows whose words also start in a document with a smaller id."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, tags, doc, at, prints = _unpacked(rows, np.uint64)
        order, heads = _by_print(prints)
        own = ids[doc[order]]
        sizes = np.diff(np.concatenate((heads, [len(order)])))
        chosen = np.sort(order[own > np.repeat(np.minimum.reduceat(own, heads), sizes)])
        return _by_document(ids, tags, doc, at, chosen)

    return packed.groupBy("bucket").applyInPandas(run, FOUND)


def squeezed(docs: DataFrame) -> DataFrame:
    """docs with each text compressed: that is what moves when found places are joined to their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in column(batch, "text").to_pylist()]
            packed = [pa.compress(t, codec="zstd", asbytes=True) if t else b"" for t in texts]
            columns = [column(batch, "doc_id"), column(batch, "tag"), pa.array(list(map(len, texts)), pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "size", "packed"])

    return docs.mapInArrow(run, "doc_id long, tag long, size long, packed binary")


def unsqueezed(part: pa.RecordBatch) -> pa.Array:
    pairs = zip(column(part, "packed").to_pylist(), column(part, "size").to_pylist(), strict=True)
    return pa.array([pa.decompress(p, n, codec="zstd", asbytes=True) if n else b"" for p, n in pairs], pa.large_binary()).cast(pa.large_string())


def _with_places(docs: DataFrame, found: DataFrame) -> DataFrame:
    places = found.groupBy("doc_id", "tag").agg(F.collect_list("place").alias("places"))
    places = places.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "places").hint("shuffle_hash")
    on = (F.coalesce(docs["doc_id"], F.lit(int(LAST_ID))) == F.col("_id")) & (docs["tag"] == F.col("_tag"))
    return docs.join(places, on, "left").select("doc_id", "tag", "size", "packed", "places")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the text of the words that stay, for every row."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    buckets = buckets_for(docs, "text")
    hot = docs.sparkSession.sparkContext.broadcast(hot_windows(docs, window))
    hits = shared_blocks(probes(docs, buckets, window, hot), window)
    small = squeezed(docs)
    removed = later_windows(around_hits(_with_places(small, hits), buckets, window, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "packed", PACKED_BYTES):
                words = words_of(unsqueezed(part), NONSPACE)
                data = words.data.tobytes()
                n = words.counts()
                lost, kept = [], []
                _, common = _whole_hot(words, hot.value.blocks, window)
                ids, _ = _ids(part)
                text, place = _in_text(words, common)
                if len(common):
                    later = hot.value.first[np.searchsorted(hot.value.windows, words.window_hashes(common, window))] < ids[text]
                    text, place = text[later], place[later]
                own = np.searchsorted(text, np.arange(len(part) + 1))
                for t, places in enumerate(column(part, "places").to_pylist()):
                    a, b = words.first[t], words.first[t + 1]
                    stays = np.ones(n[t], dtype=bool)
                    at = place[own[t] : own[t + 1]]
                    if places:
                        at = np.concatenate((at, np.frombuffer(b"".join(places), dtype=np.uint32).astype(np.int64)))
                    if len(at):
                        change = np.zeros(n[t] + 1, dtype=np.int32)
                        np.add.at(change, at, 1)
                        np.add.at(change, at + window, -1)
                        stays = np.cumsum(change)[:-1] == 0
                    lost.append(int(n[t] - stays.sum()))
                    spans = zip(words.starts[a:b][stays].tolist(), words.ends[a:b][stays].tolist(), strict=True)
                    kept.append(b" ".join([data[s:e] for s, e in spans]))
                columns = [column(part, "doc_id"), pa.array(n.astype(np.int64)), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return _with_places(small, removed).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op10_fixed_blocks(spark, sf_dir: str) -> DataFrame:
    """What every document keeps when repeats of 13 words or more stay in their first document only."""
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
), firsts AS (
  SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
), lost AS (
  SELECT DISTINCT doc_id, i + o AS p FROM windows JOIN firsts USING (h), (SELECT unnest(range(0, 13)) AS o) WHERE doc_id > first_id
), places AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n FROM places ANTI JOIN lost USING (doc_id, p) GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
