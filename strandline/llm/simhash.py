"""Near-duplicates by SimHash, compared bit-sliced.

Fingerprints of a candidate group lie vertically: word j of plane b holds bit b of 64 fingerprints. Probes are held
against whole planes; carry-save counters add up the differing bits of 64 fingerprints at once, and blocks in which every
counter is over the radius are dropped from the remaining planes.

Candidates: two fingerprints that differ in at most r bits agree in one of r + 1 parts of the 64 bits, so bits of the
parts are the keys that deal out the distinct fingerprints. Key widths follow the number of fingerprints, so that groups
are large enough for the planes to carry the work; no width loses a pair. Equal fingerprints are one node. Each group
returns a link to the smallest linked fingerprint instead of all its pairs; components follow by alternating star steps
over the links.

Defined cases: a null text is an empty one; texts without words have fingerprint zero and are linked like others; a very
long text is read whole, its shingles counted in steps of 16,384; ties of a bit (set in just half the shingles) leave it
0; repeated rows get equal results; a null id is no component's name unless it stands alone; other columns are not read,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .base import LOWER, NONSPACE, SLICE_BYTES, column, free_name, slices, words_of, written

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints that share a key, about: enough that planes of 64 are full. What is found does not depend on it.
GROUP = 256
#: Distinct fingerprints of one key that one task compares; larger groups are dealt out as pairs of tiles of this size.
TILE = 4096
#: Words (a probe against 64 fingerprints) that one numpy step takes.
STEP = 1 << 15
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half the 64-bit hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at : at + 16384]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    words = words_of(texts, NONSPACE, LOWER)
    data = words.data.tobytes()
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for t in range(len(texts)):
        a, b = words.first[t], words.first[t + 1]
        if a == b:
            continue
        own = [data[s:e] for s, e in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist(), strict=True)]
        joined = b" ".join(own)
        ends = np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        k = min(shingle, len(own))
        pairs = zip(starts[: len(own) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
        out[t] = majority(np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), dtype=np.uint64, count=len(own) - k + 1))
    return out


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tag (a hash of the text) and fp, the signed 64-bit fingerprint, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                prints = _fingerprints_of(column(part, "text"), shingle)
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "tag"), pa.array(prints.view(np.int64))], ["doc_id", "tag", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, tag long, fp long")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words: bit i of word j of row b is bit b of fingerprint 64 j + i."""
    padded = np.zeros(-(-len(prints) // 64) * 64, dtype=np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T.copy(), axis=1, bitorder="little")).view("<u8").astype(np.uint64)


def _over(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """The bits whose counter (one bit of it in each level) is over the radius, or has run over."""
    same = np.full(len(over), FULL)
    for level in range(len(counters) - 1, -1, -1):
        if (radius >> level) & 1:
            same = same & counters[level]
        else:
            over = over | (same & counters[level])
            same = same & ~counters[level]
    return over


def close_pairs(prints: np.ndarray, radius: int, ends: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i < j of all fingerprints that differ in at most radius bits, in parts. With ends, only j < ends[i]: many
    groups lie one after another in the same planes, so small ones fill the words together.

    Each probe is held against blocks of 64 fingerprints, plane by plane. Carry-save counters of as many levels as the
    radius has bits add up 64 distances at once; blocks whose counters are all over the radius leave the rest of the
    planes."""
    n = len(prints)
    ends = np.full(n, n) if ends is None else ends
    planes = bit_planes(prints)
    every = np.arange(n)
    from_block = (every + 1) // 64
    blocks = np.where(ends > every + 1, (ends - 1) // 64 - from_block + 1, 0)
    through = np.cumsum(blocks)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(through, (through[first - 1] if first else 0) + STEP, side="right")))
        own, many = prints[first:last], blocks[first:last]
        flips = np.where((own[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1), FULL, np.uint64(0))
        probe = np.repeat(np.arange(last - first), many)
        block = np.repeat(from_block[first:last] - (np.cumsum(many) - many), many) + np.arange(len(probe))
        counters = [np.zeros(len(probe), dtype=np.uint64) for _ in range(radius.bit_length())]
        # places up to the probe's own, or behind its group, count as far: blocks that hold them can be left like others
        low = np.clip(first + probe + 1 - 64 * block, 0, 63).astype(np.uint64)
        high = np.clip(64 * (block + 1) - ends[first + probe], 0, 63).astype(np.uint64)
        over = ~((FULL << low) & (FULL >> high))
        beyond = over
        for b in range(64):
            if not len(probe):
                break
            carry = planes[b][block] ^ flips[b][probe]
            for level, counter in enumerate(counters):
                counters[level], carry = counter ^ carry, counter & carry
            over = over | carry
            if b % 8 == 7:
                beyond = _over(counters, over, radius)
                keep = beyond != FULL
                if not keep.all():
                    probe, block, over, beyond = probe[keep], block[keep], over[keep], beyond[keep]
                    counters = [c[keep] for c in counters]
        if len(probe):
            rows, at = np.nonzero(np.unpackbits((~beyond).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield first + probe[rows], block[rows] * 64 + at
        first = last


def merged(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """root (each place's smallest known partner) after joining i and j, pair by pair."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _links(prints: np.ndarray, radius: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For groups of fingerprints: links that connect exactly what each group's close pairs connect, one each at most."""
    root = np.arange(len(prints))
    for i, j in close_pairs(prints, radius, ends):
        root = merged(root, i, j)
    moved = np.flatnonzero((root != np.arange(len(prints))) & (prints != prints[root]))
    return prints[moved], prints[root[moved]]


def _keys(radius: int, count: int) -> list[str]:
    """SQL of radius + 1 keys of fp: fingerprints within the radius agree in one of as many parts of the bits. A key has
    so many bits of its part that GROUP of count fingerprints, if evenly spread, share one."""
    width = max(0, (max(count, 1) // GROUP).bit_length())
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [f"xxhash64({i}, shiftrightunsigned(fp, {a}) & {(1 << min(width, b - a)) - 1}L)" for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def tiled(members: DataFrame, name: str, tile: int) -> DataFrame:
    """members (with key, and n_members of the key) with tiles: a key with more members than a tile has a row for each
    pair of tiles that holds the member's own one."""
    tiles = F.ceil(F.col("n_members") / tile).cast("int")
    own = F.pmod(F.xxhash64(name), tiles).cast("int")
    pairs = F.explode(F.transform(F.sequence(F.lit(0), tiles - 1), lambda t: F.least(t, F.col("own_tile")) * 65536 + F.greatest(t, F.col("own_tile"))))
    return members.withColumn("own_tile", own).withColumn("tiles", pairs).drop("own_tile", "n_members")


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links between distinct fingerprints fp of nodes that connect what pairs within the radius connect."""
    keyed = nodes.select("fp", F.explode(F.array(*map(F.expr, _keys(radius, nodes.count())))).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_members")).filter("n_members > 1")
    dealt = tiled(keyed.join(counts, "key"), "fp", TILE)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, ends in groups_of(frames, ["key", "tiles"]):
            a, b = _links(part["fp"].to_numpy().view(np.uint64), radius, ends)
            if len(a):
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.repartition("key", "tiles").sortWithinPartitions("key", "tiles").mapInPandas(run, "a long, b long").distinct()


def groups_of(frames: Iterator[pd.DataFrame], names: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Whole groups of consecutive rows with equal values of names, over the borders of frames: rows, and for each row the
    end of its group among them."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat((held, frame), ignore_index=True)
        cuts = _cuts(frame, names)
        if len(cuts):
            held = frame.iloc[cuts[-1] :]
            yield frame.iloc[: cuts[-1]], np.repeat(cuts, np.diff(cuts, prepend=0))
        else:
            held = frame
    if held is not None and len(held):
        yield held, np.full(len(held), len(held))


def _cuts(frame: pd.DataFrame, names: list[str]) -> np.ndarray:
    """Places at which a row's values of names differ from those of the row before."""
    values = [frame[name].to_numpy() for name in names]
    return np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1


def _settling(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """edges written, with their number and a checksum from the same job."""
    seen = Observation()
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")))
    return out, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root (the smallest node of its component) for all nodes of edges (a, b). Alternating star steps: each node
    hands its larger, then its smaller neighbours to the smallest one it knows, until nothing changes. A round is one
    job."""
    now, mark = _settling(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        both = now.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        after, new = _settling(moved.union(small.select("a", F.col("m").alias("b"))).distinct())
        if new == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now, mark = after, new
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, tag (a hash of the text), fp, group (its component's smallest fingerprint) and component_id (the smallest
    id that is reachable over links) for every row."""
    prints = written(fingerprinted(docs, doc_id, text, shingle))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(nodes, radius))
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("group"))
    names = linked.groupBy("group").agg(F.min("least_id").alias("component_id"))
    named = linked.join(names, "group").select("fp", "group", "component_id")
    return prints.join(named, "fp").select("doc_id", "tag", "fp", "group", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of docs that stay: of each component the one with the smallest id (a null one last), then text hash."""
    return first_of_each(docs, near_duplicates(docs, doc_id, text, shingle, radius), doc_id, text)


#: Rows (an id and a text hash) up to which a list is broadcast to the documents; beyond that both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def sent(rows: DataFrame) -> DataFrame:
    """rows written, and marked for a broadcast if they are few."""
    rows = written(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def first_of_each(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay by the groups found (doc_id, tag, group; one row for each of docs). Only ids and hashes
    of those that go are joined to the texts, and only rows that repeat an id with its text are told apart by a shuffle."""
    own, least, tag = (free_name(docs, name) for name in ("own", "least", "tag"))
    rows = found.groupBy("group", "doc_id", "tag").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first"))
    judged = rows.join(first, "group").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tag") == F.col("first.tag")))
    judged = written(judged.select("doc_id", "tag", "n", "stays"))
    tagged = docs.withColumn(own, F.xxhash64(text))
    here = F.col(doc_id).cast("long").eqNullSafe(F.col(least)) & (F.col(own) == F.col(tag))
    lost = sent(judged.filter("NOT stays").select(F.col("doc_id").alias(least), F.col("tag").alias(tag)))
    stay = tagged.join(lost, here, "left_anti")
    repeated = sent(judged.filter("stays AND n > 1").select(F.col("doc_id").alias(least), F.col("tag").alias(tag)))
    if not repeated.isEmpty():
        stay = stay.join(repeated, here, "left_anti").unionByName(stay.join(repeated, here, "left_semi").dropDuplicates([doc_id, own]))
    return stay.drop(own)


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: three-word shingles, at most two differing bits."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
