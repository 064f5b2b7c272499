"""Near copies by the Jaccard similarity of word shingles, found by SimHash planes and verified by the whole sets.

Two texts whose sets of five-word shingles have a Jaccard similarity of at least 4/5 are linked; components of the links
are groups of copies. Texts are dealt out by BANDS keys, each of ROWS minima of permuted shingles: a similar pair shares
no key with odds of (1 - 0.8 ** ROWS) ** BANDS = 1e-5 at most, and less the more alike it is. Within a key, SimHash
fingerprints of the sets are compared bit-sliced (`simhash.close_pairs`) at a radius that a similar pair exceeds with
odds of about 1e-6; what is left passes two bounds that no similar pair exceeds, sizes and bitmaps in which every shingle
flips one bit, and then the whole sets.

The first rounds hand on only as many pairs as connect what the bounds let pass, so a group of copies costs its size and
not its square. Each text is paired with the partner that a hash names, in WAYS ways by key and anew in each round, since
of a family of texts about as similar as the bound many are not similar to any one of it. The last round takes every pair that is still in different components, so none is left undecided.

Defined cases: a text of fewer than five words is one shingle; texts without words are copies of each other; a null text
is an empty one; a very long text is read whole; repeated rows get equal results; of equal ids the smaller text hash
stays; other columns stay as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LOWER, NONSPACE, SLICE_BYTES, column, mixed, slices, words_of, written
from .simhash import close_pairs, components, first_of_each, groups_of, majority, merged, sent, tiled

SHINGLE = 5
BANDS, ROWS = 16, 3
#: Differing bits of 64. Sets of similarity 0.8 differ in 9.7 bits on average, with a deviation of 2.9.
RADIUS = 24
#: Members of one key that one task compares; larger groups are dealt out as pairs of tiles of this size.
TILE = 2048
#: Rounds that hand on a spanning forest of each group, before the round that hands on all pairs.
FOREST_ROUNDS = 2
#: Ways in which the keys of one round choose partners: a text that is not similar to one of a group's hubs meets others.
WAYS = 3
LEAST_BITS, MOST_BITS = 64, 8192

_PERMUTE = np.random.default_rng(811).integers(0, 2**63, (BANDS * ROWS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(texts, NONSPACE, LOWER)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        k = min(shingle, b - a)
        out.append(np.unique(words.window_hashes(np.arange(a, b - k + 1), k)) if k else np.zeros(0, dtype=np.uint64))
    return out


def _node(own: np.ndarray) -> int:
    """The name of a set, as a signed number."""
    name = xxhash.xxh64_intdigest(own.tobytes())
    return name - (1 << 64) if name >> 63 else name


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS keys for each set that is not empty; one key for all empty sets."""
    out = np.zeros((len(sets), BANDS), dtype=np.uint64)
    some = [t for t, own in enumerate(sets) if len(own)]
    if some:
        flat = np.concatenate([sets[t] for t in some])
        heads = np.cumsum([0] + [len(sets[t]) for t in some[:-1]])
        for band in range(BANDS):
            key = np.full(len(some), np.uint64(band + 1))
            for a, b in _PERMUTE[band * ROWS : (band + 1) * ROWS]:
                least = np.minimum.reduceat(flat * a + b, heads)
                key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out[some, band] = key
    return out


def bitmap(own: np.ndarray) -> bytes:
    """A bit is set if an odd number of the set's shingles fall on it; halves of a longer bitmap add up to a shorter one."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << max(len(own) - 1, 0).bit_length()))
    return np.packbits(np.bincount((own % np.uint64(width)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def _differing(maps: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps i and j differ, pair by pair, at the shorter one's width."""
    size = np.array([len(m) for m in maps])
    width = np.minimum(size[i], size[j])
    out = np.zeros(len(i), dtype=np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        used, place = np.unique(np.concatenate((i[at], j[at])), return_inverse=True)
        rows = np.stack([_folded(maps[u], w) for u in used.tolist()])
        for a in range(0, len(at), 4096):
            part = at[a : a + 4096]
            x, y = place[a : a + len(part)], place[len(at) + a : len(at) + a + len(part)]
            out[part] = np.bitwise_count(rows[x] ^ rows[y]).sum(axis=1, dtype=np.int64)
    return out


def described(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """doc_id, tag (a hash of the text), node (the name of its set), n (shingles), fp, bits and keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = _sets(column(part, "text"), shingle)
                keys = band_keys(own).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id"),
                        column(part, "tag"),
                        pa.array([_node(s) for s in own], pa.int64()),
                        pa.array([len(s) for s in own], pa.int32()),
                        pa.array(np.array([majority(s) for s in own], dtype=np.uint64).view(np.int64)),
                        pa.array([bitmap(s) for s in own], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "tag", "node", "n", "fp", "bits", "keys"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, tag long, node long, n int, fp long, bits binary, keys array<long>")


def group_pairs(node: np.ndarray, n: np.ndarray, fp: np.ndarray, bits: list[bytes], label: np.ndarray, every: bool, ends: np.ndarray | None = None, way: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of the members of groups: the pairs of different labels within radius and bounds, or (not every) so many that
    connect the same; of the partners that a part can have the first by a hash with the group's way (a number)."""
    maps = [np.frombuffer(b, dtype="<u8") for b in bits]
    n = n.astype(np.int64)
    root = np.unique(label, return_index=True, return_inverse=True)
    root = root[1][root[2]]
    out_a, out_b = [], []
    place = mixed(node.view(np.uint64) ^ mixed(np.zeros(len(node), dtype=np.uint64) if way is None else way.astype(np.uint64)))
    for i, j in close_pairs(fp.view(np.uint64), RADIUS, ends):
        fit = (root[i] != root[j]) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
        i, j = i[fit], j[fit]
        if len(i):
            near = 9 * _differing(maps, i, j) <= n[i] + n[j]
            i, j = i[near], j[near]
        if not every and len(i):
            # of the pairs that join the same two parts the first; again until a round joins nothing
            kept_i, kept_j = [], []
            while len(i):
                a, b = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
                apart = np.flatnonzero(a != b)
                if not len(apart):
                    break
                partner = np.where(root[i[apart]] == a[apart], i[apart], j[apart])
                order = np.lexsort((place[partner], b[apart]))
                _, first = np.unique(b[apart][order], return_index=True)  # each part joins one smaller part
                chosen = apart[order[first]]
                kept_i.append(i[chosen])
                kept_j.append(j[chosen])
                root = merged(root, i[chosen], j[chosen])
                i, j = i[apart], j[apart]
            i, j = np.concatenate([i[:0], *kept_i]), np.concatenate([j[:0], *kept_j])
        out_a.append(node[i])
        out_b.append(node[j])
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def candidates(shared: DataFrame, every: bool, step: int = 0) -> DataFrame:
    """a < b: pairs of nodes to verify. shared: key, node, n, fp, bits, label, n_members (nodes of the key)."""
    dealt = tiled(shared, "node", TILE)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, ends in groups_of(frames, ["key", "tiles"]):
            a, b = group_pairs(part["node"].to_numpy(), part["n"].to_numpy(), part["fp"].to_numpy(), part["bits"].tolist(), part["label"].to_numpy(), every, ends, WAYS * step + part["key"].to_numpy() % WAYS)
            if len(a):
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.repartition("key", "tiles").sortWithinPartitions("key", "tiles", "node").mapInPandas(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, first: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. first: node and doc_id, tag of a row that has its set."""
    wanted = sent(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(first, "node").select("doc_id", "tag"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = _sets(column(part, "text"), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in own], pa.int64()), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))], ["node", "own"])

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_tag"), F.col(text).alias("text"))
    rows = rows.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tag") == F.col("tag")), "left_semi").dropDuplicates(["_id", "_tag"])
    sets = written(rows.select("text").mapInArrow(run, "node long, own array<long>"))
    left = sets.select(F.col("node").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    both = F.size(F.array_intersect("own_a", "own_b"))
    return pairs.join(left, "a").join(right, "b").filter(9 * both >= 4 * (F.size("own_a") + F.size("own_b"))).select("a", "b")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tag (a hash of the text) and group (one number for all texts linked by similar sets) of every row."""
    rows = written(described(docs, doc_id, text, shingle))
    nodes = written(rows.dropDuplicates(["node"]))
    first = nodes.select("node", "doc_id", "tag")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_members")).filter("n_members > 1")
    shared = written(keyed.join(counts, "key").join(nodes.select("node", "n", "fp", "bits"), "node"))
    edges, labels = None, None
    for step in range(FOREST_ROUNDS + 1):
        now = shared.withColumn("label", F.col("node")) if labels is None else shared.join(labels.toDF("node", "root"), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
        pairs = written(candidates(now, step == FOREST_ROUNDS, step))
        if pairs.isEmpty():
            break
        more = verified(pairs, docs, doc_id, text, first, shingle)
        edges = written((more if edges is None else edges.union(more)).distinct())
        labels = components(edges)
    if labels is None:
        return rows.select("doc_id", "tag", F.col("node").alias("group"))
    return rows.select("doc_id", "tag", "node").join(labels, "node", "left").select("doc_id", "tag", F.coalesce("root", "node").alias("group"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs that stay: of each group the one with the smallest id (a null one last), then text hash."""
    return first_of_each(docs, grouped(docs, doc_id, text, shingle), doc_id, text)
