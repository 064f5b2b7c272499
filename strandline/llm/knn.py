"""Exact top-k by inner product as a Voronoi join.

Pivots (PIVOTS vectors, chosen by a hash of their id) part the space; each vector belongs to its nearest pivot. Of each
cell one summary is kept: how many vectors, the largest distance to the pivot, the largest norm. Queries are grouped by
their own cell. In the first round a query goes to the NEAR cells of its group that promise most, which gives it a k-th
score that the final one cannot be under. For a cell with pivot p and radius r no score exceeds q.p + |q| r, nor |q|
times the largest norm; so in the second round a query goes only to those other cells whose bound reaches its k-th score
- and, before that, its group's bound is tested against the group's least k-th score, one test for the whole group.
Vectors move once, to their cell; only queries are replicated, and only to cells that may matter. Cells over BLOCK
vectors are split, so a vector that a third of all rows hold makes more blocks, not a larger one; so are the queries of a
cell that more than BLOCK of them ask.

Summaries and pivots have a bound (PIVOTS rows of the vectors' dimension) and go through the driver. Scores are
integers; bounds are floats with slack, so rounding never drops a cell.

The bounds exclude cells where vectors lie in clusters. Where they spread evenly over a sphere of many dimensions, as the
driver's do, no summary of a cell can exclude one, and the join compares all queries with all vectors, in blocks.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part; a null id neither; rows of
one id are candidates each, but not of each other, and share one ranking as a query; vectors of different lengths are
compared as if padded with zeros, very long ones whole; scores are exact while they and their partial sums stay under
2 ** 63; fewer candidates than k give fewer rows; ties go to the smaller id; other columns are not read, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import written

SCALE = 1024
#: Most pivots; fewer vectors take half the root of their number.
PIVOTS = 4096
#: Vectors, and queries, that one task holds of a cell.
BLOCK = 4096
NEAR = 3
#: Relative slack of the float bounds.
SLACK = 1e-9


def scaled(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE, keep: Sequence[str] = ()) -> DataFrame:
    """vec_id, v (array of long): floor(scale * x) of the vectors that take part; then the columns of keep."""
    x = F.col(embedding)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), ints.alias("v"), *keep)


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype=np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; as floats where no partial sum can leave the exact range."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if most < 2**52 else a @ b.T


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of data for each query, its own id left out."""
    out = []
    order = np.argsort(ids, kind="stable")
    ids, data = ids[order], data[order]
    for at in range(0, len(query_ids), 256):
        scores = _scores(queries[at : at + 256], data)
        for q, row in zip(query_ids[at : at + 256].tolist(), scores, strict=True):
            own = ids != q
            row, names = row[own], ids[own]
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                keep = np.flatnonzero(row >= least)
                keep = keep[np.argsort(-row[keep], kind="stable")][:k]
            else:
                keep = np.argsort(-row, kind="stable")
            out.append(pd.DataFrame({"query_id": np.full(len(keep), q), "vec_id": names[keep], "score": row[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


FOUND = "query_id long, vec_id long, score long"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector with is_query (a column over vec_id) its k best others."""
    spark = vectors.sparkSession
    data = written(scaled(vectors, vec_id, embedding, scale))
    count, width = data.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    few = max(2, min(pivots, int(count**0.5 / 2)))
    chosen = data.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(few).collect()
    centres = np.unique(_matrix(pd.Series([r["v"] for r in chosen], dtype=object), width), axis=0).astype(np.float64)
    if not len(centres):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shared = spark.sparkContext.broadcast(centres)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 8192):
                part = frame.iloc[at : at + 8192]
                x = _matrix(part["v"], width).astype(np.float64)
                c = shared.value
                cell = ((c**2).sum(axis=1)[None, :] - 2 * (x @ c.T)).argmin(axis=1)
                yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "cell": cell.astype(np.int32), "far": np.sqrt(((x - c[cell]) ** 2).sum(axis=1)), "norm": np.sqrt((x**2).sum(axis=1))})

    placed = written(data.mapInPandas(assign, "vec_id long, v array<long>, cell int, far double, norm double"))
    summary = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).orderBy("cell").toPandas()
    cells, size = summary["cell"].to_numpy(), summary["n"].to_numpy()
    radius, norm = summary["far"].to_numpy() * (1 + SLACK), summary["norm"].to_numpy() * (1 + SLACK)
    hubs = centres[cells]
    queries = placed.filter(is_query)
    blocks = {int(c): int(-(-n // block)) for c, n in zip(cells, size, strict=True)}
    counts = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    dealt = placed.select("cell", F.pmod(F.xxhash64("vec_id"), counts[F.col("cell")]).cast("int").alias("block"), "vec_id", "v")

    def bounds(q: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What no score of the queries in each cell exceeds."""
        direct = q @ hubs.T
        wide = direct + length[:, None] * radius[None, :]
        return np.minimum(wide, length[:, None] * norm[None, :]) + SLACK * (np.abs(direct) + length[:, None] * norm[None, :]) + 1e-6

    def solved(asked: DataFrame) -> DataFrame:
        """Best of each query among the vectors of the cells it asks; asked: query_id, v, cell. Where many queries ask a
        cell they are dealt into groups too, and each group meets every block of the cell."""
        asked = written(asked)
        sizes = {r["cell"]: -(-r["n"] // block) for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            return spark.createDataFrame([], FOUND)
        groups = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
        many = F.explode(F.sequence(F.lit(0), counts[F.col("cell")] - 1)).alias("block")
        asked = asked.select("cell", many, F.pmod(F.xxhash64("query_id"), groups[F.col("cell")]).cast("int").alias("grp"), "query_id", F.col("v").alias("q"))
        met = dealt.filter(groups[F.col("cell")].isNotNull()).select("cell", "block", F.explode(F.sequence(F.lit(0), groups[F.col("cell")].cast("int") - 1)).alias("grp"), "vec_id", "v")

        def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
            return _best(right["query_id"].to_numpy(), _matrix(right["q"], width), left["vec_id"].to_numpy(), _matrix(left["v"], width), k)

        return met.groupBy("cell", "block", "grp").cogroup(asked.groupBy("cell", "block", "grp")).applyInPandas(solve, FOUND)

    def first_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # the group of a query is its cell; its pivot stands for all of them
            order = np.argsort(-(centres[frame["cell"].to_numpy()] @ hubs.T), axis=1, kind="stable")
            near = order[:, :NEAR]
            ids, lists = np.repeat(frame["vec_id"].to_numpy(), near.shape[1]), [v for v in frame["v"] for _ in range(near.shape[1])]
            yield pd.DataFrame({"query_id": ids, "v": lists, "cell": cells[near].reshape(-1)})

    asked = queries.mapInPandas(first_cells, "query_id long, v array<long>, cell int")
    first = written(_top(solved(asked), k))
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    known = queries.join(kth, queries["vec_id"] == kth["query_id"], "left").select("vec_id", "v", "cell", "norm", "far", F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    known = written(known)
    group = known.groupBy("cell").agg(F.max("far").alias("far"), F.max("norm").alias("norm"), F.min(F.coalesce("kth", F.lit(-(2**63)))).alias("kth")).toPandas()
    # of a group with pivot a: q.p = a.p + (q - a).p, at most a.p + far |p|
    hub_norm = np.sqrt((hubs**2).sum(axis=1))
    own = centres[group["cell"].to_numpy()]
    reach = own @ hubs.T + group["far"].to_numpy()[:, None] * hub_norm[None, :] + group["norm"].to_numpy()[:, None] * radius[None, :]
    reach = np.minimum(reach, group["norm"].to_numpy()[:, None] * norm[None, :]) * (1 + SLACK) + SLACK * (np.abs(own @ hubs.T) + group["norm"].to_numpy()[:, None] * norm[None, :]) + 1e-6
    may = reach >= group["kth"].to_numpy()[:, None].astype(np.float64)
    allowed = spark.sparkContext.broadcast({int(c): row for c, row in zip(group["cell"], may, strict=True)})

    def other_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            q = _matrix(frame["v"], width).astype(np.float64)
            least = frame["kth"].astype("float64").fillna(-np.inf).to_numpy()
            done = np.argsort(-(centres[frame["cell"].to_numpy()] @ hubs.T), axis=1, kind="stable")[:, :NEAR]
            want = np.stack([allowed.value[int(c)] for c in frame["cell"]]) & (bounds(q, np.sqrt((q**2).sum(axis=1))) >= least[:, None])
            want[np.arange(len(q))[:, None], done] = False
            row, at = np.nonzero(want)
            if not len(row):
                continue
            yield pd.DataFrame({"query_id": frame["vec_id"].to_numpy()[row], "v": [frame["v"].iloc[i] for i in row], "cell": cells[at]})

    rest = known.select("vec_id", "v", "cell", "kth").mapInPandas(other_cells, "query_id long, v array<long>, cell int")
    both = solved(rest).unionByName(first.select("query_id", "vec_id", "score"))
    return _top(both, k).select("query_id", "rank", "vec_id", "score")


def op6_voronoi_top_k(spark, sf_dir: str) -> DataFrame:
    """The ten best others of every hundredth vector."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, 10)


OP6_SQL = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM fine q, fine c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
