"""Hard negatives of anchors by exact integer inner products, multiplied tile by tile with Strassen's recursion.

An anchor's positives are its best rows of the same label; a positive's negatives are the best rows of other labels whose
score lies in a window under the positive's. Anchors are dealt into groups of about ANCHORS rows, all rows into lots of
about LOT, and each pair of a group and a lot is one cell, so work and memory of a task have a bound and a label that a
third of all rows hold changes nothing: no step groups by label. In a cell the anchors come first, then the lot's rows
stream past in tiles. Each tile of anchors times candidates is one product by Strassen's recursion on int64, padded with
zeros to even sides; all sums are of integers, so nothing is rounded.

Two sweeps over the tiles. The first keeps for each anchor a heap of its best rows of the same label. The second knows
each positive's score and keeps for each positive a heap of the best rows inside its window. Heaps merge: what cells find
is at most k rows for each anchor or positive, and the last k come from one shuffle of those.

A rising number of rows raises the number of cells with its square, as all anchors are compared with all rows; rows move
once for each group of anchors, anchors once for each lot.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component take no part; an empty
table gives no rows; vectors of different lengths are compared as if padded with zeros, very long ones whole; ties go to
the smaller id, then to the row that is stored first; rows of one id are rows each (an anchor of its own, and a candidate for all
others), but not of each other; an anchor without positives, or a positive with an empty window, gives no row; scores are
exact while sums of products stay under 2 ** 63 / 100; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import column, written
from .knn import scaled

SCALE = 256
#: Rows of one group of anchors and of one lot of candidates.
ANCHORS = 2048
LOT = 8192
#: Partitions of one sweep; more cells than that share them.
MOST_TASKS = 100_000
#: Candidates of one tile.
TILE = 1024
#: Sides of a product that is not divided further.
LEAF = 32
LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices by seven products of halves; sides over leaf are padded with zeros to even ones."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * h), dtype=np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best k (score, id, row) of each of n owners; what is added merges with what is there."""

    def __init__(self, k: int):
        self.k = k
        self.owner, self.score, self.name, self.row = (np.zeros(0, dtype=np.int64) for _ in range(4))

    def add(self, scores: np.ndarray, fits: np.ndarray, names: np.ndarray, rows: np.ndarray) -> None:
        """scores (owner x candidate) of those that fit. Only those no worse than the k-th of their tile are sorted."""
        masked = np.where(fits, scores, LEAST)
        if masked.shape[1] > self.k:
            least = np.partition(masked, masked.shape[1] - self.k, axis=1)[:, masked.shape[1] - self.k]
            fits = fits & (masked >= least[:, None])
        owner, at = np.nonzero(fits)
        owner, score = np.concatenate((self.owner, owner)), np.concatenate((self.score, scores[owner, at]))
        name, row = np.concatenate((self.name, names[at])), np.concatenate((self.row, rows[at]))
        order = np.lexsort((row, name, -score, owner))
        owner = owner[order]
        first = np.searchsorted(owner, owner)
        kept = np.arange(len(owner)) - first < self.k
        self.owner, order = owner[kept], order[kept]
        self.score, self.name, self.row = score[order], name[order], row[order]


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column(batch, "v").to_pylist()), dtype="<i8").reshape(len(batch), width)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64)


def packed(data: DataFrame, width: int) -> DataFrame:
    """row, vec_id, label, v: vectors as bytes of width longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "v")
            sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            out = np.zeros((len(batch), width), dtype="<i8")
            out[np.repeat(np.arange(len(batch)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            rows = pa.array([v.tobytes() for v in out], pa.binary())
            yield pa.RecordBatch.from_arrays([column(batch, "row"), column(batch, "vec_id"), column(batch, "label"), rows], names=["row", "vec_id", "label", "v"])

    return data.mapInArrow(run, "row long, vec_id long, label long, v binary")


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _cells(anchors: DataFrame, data: DataFrame, groups: int, lots: int) -> DataFrame:
    """Rows of every cell (group and lot), its anchors first."""
    known = ["vec_id", "label", "row", "v"]
    lot, group = F.pmod(F.xxhash64("row"), F.lit(lots)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups))
    asked = anchors.select(group.alias("grp"), _numbers(lots).alias("lot"), F.lit(0).alias("kind"), *known, "bounds")
    rows = data.select(_numbers(groups).alias("grp"), lot.alias("lot"), F.lit(1).alias("kind"), *known, F.lit(None).cast("array<long>").alias("bounds"))
    # a cell is much work for few bytes, so the number of partitions is given and not left to sizes
    return asked.unionByName(rows).repartition(min(4 * groups * lots, MOST_TASKS), "grp", "lot").sortWithinPartitions("grp", "lot", "kind")


def _swept(cells: DataFrame, width: int, k: int, upper: int | None, lower: int | None) -> DataFrame:
    """anchor, place, score, vec_id, row: the best k of each anchor (place 0) in each cell, or, if bounds are given, of each
    of its positives in the window lower * p <= 100 * score <= upper * p."""

    def found(anchors: list[pa.RecordBatch], heaps: list[Heaps]) -> Iterator[pa.RecordBatch]:
        own = np.concatenate([_longs(b, "row") for b in anchors]) if anchors else np.zeros(0, dtype=np.int64)
        for place, heap in enumerate(heaps):
            if len(heap.owner):
                columns = [own[heap.owner], np.full(len(heap.owner), place), heap.score, heap.name, heap.row]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "place", "score", "vec_id", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchors, heaps, facts = None, [], [], None
        for batch in batches:
            cell = np.stack([_longs(batch, "grp"), _longs(batch, "lot"), _longs(batch, "kind")])
            cuts = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if a == b:
                    continue
                part, own = batch.slice(a, b - a), tuple(cell[:2, a].tolist())
                if own != now:
                    yield from found(anchors, heaps)
                    now, anchors, heaps, facts = own, [], [], None
                if cell[2, a] == 0:
                    anchors.append(part)
                    continue
                if not anchors:
                    continue
                if facts is None:
                    bounds = [x for b in anchors for x in column(b, "bounds").to_pylist()]
                    most = max((len(x) for x in bounds if x), default=0) if upper is not None else 1
                    table = np.full((len(bounds), most), LEAST, dtype=np.int64)
                    for i, own_bounds in enumerate(bounds if upper is not None else []):
                        table[i, : len(own_bounds)] = own_bounds
                    facts = np.concatenate([_vectors(b, width) for b in anchors]), np.concatenate([_longs(b, "vec_id") for b in anchors]), np.concatenate([_longs(b, "label") for b in anchors]), table
                    heaps = [Heaps(k) for _ in range(most)]
                for at in range(0, len(part), TILE):
                    tile = part.slice(at, TILE)
                    scores = strassen(facts[0], np.ascontiguousarray(_vectors(tile, width).T))
                    names, labels, rows = _longs(tile, "vec_id"), _longs(tile, "label"), _longs(tile, "row")
                    same = facts[2][:, None] == labels[None, :]
                    if upper is None:
                        heaps[0].add(scores, same & (facts[1][:, None] != names[None, :]), names, rows)
                        continue
                    for place, heap in enumerate(heaps):
                        p = facts[3][:, place][:, None]
                        # a missing positive, or one of a negative score, has no window
                        fits = ~same & (p >= 0) & (100 * scores <= upper * p) & (100 * scores >= lower * p)
                        heap.add(scores, fits, names, rows)
        yield from found(anchors, heaps)

    return cells.mapInArrow(run, "anchor long, place long, score long, vec_id long, row long")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, lower: int = 80, upper: int = 100, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    scale: int = SCALE, anchors_a_group: int = ANCHORS, lot: int = LOT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row with is_anchor (a column over
    vec_id) and each of its best positives the best rows of other labels with lower * p <= 100 * score <= upper * p, where
    p is the positive's score (upper is at least lower, both at least 0)."""
    spark = vectors.sparkSession
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"), F.col(label).cast("long").alias("label"))
    fine = scaled(named.filter("label IS NOT NULL"), "vec_id", "v", scale, keep=["label"])
    count, width = fine.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(1, width)
    # written, so that a row's number is the same in every later step, whichever executor is lost
    data = written(packed(fine.withColumn("row", F.monotonically_increasing_id()), width))
    asked = data.filter(is_anchor)
    groups, lots = max(1, -(-asked.count() // anchors_a_group)), max(1, -(-count // lot))
    none = F.lit(None).cast("array<long>").alias("bounds")
    first = _swept(_cells(asked.select("*", none), data, groups, lots), width, positives, None, None)
    chosen = written(_best(first, ["anchor"], positives).select("anchor", F.col("rank").alias("place"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")))
    bounds = chosen.groupBy(F.col("anchor").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"]).alias("bounds"))
    second = _swept(_cells(asked.join(bounds, "row"), data, groups, lots), width, negatives, upper, lower)
    best = _best(second.withColumn("place", F.col("place") + 1), ["anchor", "place"], negatives).select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(chosen, ["anchor", "place"]).join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_strassen_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with every seventh label moved on by one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH fine AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM fine a, fine c WHERE a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
