"""Coordinates through blocks of an assembly or alignment."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grouped import Group, in_groups
from .intervals import JOIN_BIN, overlaps


def projected(rows: DataFrame, blocks: DataFrame, keys: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """Pieces of rows on the target: blocks have keys, start, end, target, target_start, orientation (1 or -1). Each piece
    has its source start and end and target_start, target_end; a reversed block counts from its far end."""
    pairs = overlaps(rows, blocks, keys, width)
    low, high = F.greatest("start", "r_start"), F.least("end", "r_end")
    ahead = F.col("r_orientation") == 1
    target_low = F.when(ahead, F.col("r_target_start") + low - F.col("r_start")).otherwise(F.col("r_target_start") + F.col("r_end") - high)
    kept = [c for c in rows.columns if c not in ("start", "end")]
    return pairs.select(
        *kept, low.alias("start"), high.alias("end"), F.col("r_target").alias("target"), target_low.alias("target_start"), (target_low + high - low).alias("target_end"), F.col("r_orientation").alias("orientation")
    )


def coverage_of_projection(rows: DataFrame, pieces: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """row_id, length, mapped, gaps: bases of each row, those with a place on the target, and the pieces' count less one."""
    mapped = pieces.groupBy(*row_id).agg(F.sum(F.col("end") - F.col("start") + 1).alias("mapped"), (F.count(F.lit(1)) - 1).alias("gaps"))
    lengths = rows.groupBy(*row_id).agg(F.sum(F.col("end") - F.col("start") + 1).alias("length"))
    return lengths.join(mapped, list(row_id), "left").withColumn("mapped", F.coalesce("mapped", F.lit(0))).withColumn("gaps", F.coalesce("gaps", F.lit(0)))


def one_to_one(blocks: DataFrame, by: Sequence[str], row_id: str, score: str) -> DataFrame:
    """row_id, by, start, end, target_start: parts of ungapped blocks (row_id, by, start, end, target_start, forward on both
    sides) that make a one-to-one map between two sequences, both rising.

    Blocks are taken by score (ties: the smaller id) and lose what a taken part covers on either side. If a part that is
    left does not lie between the same taken parts on both sides, the whole block goes. Sequential for each pair of
    sequences (by), of which taken parts are searched by bisection."""
    by = list(by)
    rows = blocks.select(row_id, *by, "start", "end", "target_start", score)
    kinds = dict(rows.dtypes)

    def run(group: Group) -> Iterator[tuple]:
        place = tuple(group[b][0] for b in by)
        starts, parts = [], []  # taken parts (start, end, target_start, target_end), rising on both sides
        targets: list[int] = []
        out = []
        for name, s, e, t in zip(*(group[c] for c in (row_id, "start", "end", "target_start")), strict=True):
            shift, gone = t - s, []
            low = max(bisect_right(starts, s) - 1, 0)
            for i in range(low, len(parts)):
                if parts[i][0] > e:
                    break
                gone.append((parts[i][0], parts[i][1]))
            low = max(bisect_right(targets, t) - 1, 0)
            for i in range(low, len(parts)):
                if parts[i][2] > e + shift:
                    break
                gone.append((parts[i][2] - shift, parts[i][3] - shift))
            left, at = [], s
            for a, b in sorted(gone):
                if b < at:
                    continue
                if a > at:
                    left.append((at, min(a - 1, e)))
                at = b + 1
            if at <= e:
                left.append((at, e))
            left = [(a, b) for a, b in left if a <= b]
            fits = all(bisect_right(starts, a) == bisect_right(targets, a + shift) for a, _ in left)
            if not fits:
                continue
            for a, b in left:
                at = bisect_right(starts, a)
                starts.insert(at, a)
                targets.insert(at, a + shift)
                parts.insert(at, (a, b, a + shift, b + shift))
                out.append((name, *place, a, b, a + shift))
        return out

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (row_id, *by)) + ", start long, end long, target_start long"
    return in_groups(rows, by, [F.desc(score), row_id], run, schema)


def joined_pieces(pieces: DataFrame, row_id: Sequence[str], gap: int) -> DataFrame:
    """Pieces of rows on one target, neighbours of which are at most gap bases apart on both sides and rise on both, as one:
    row_id, target, target_start, target_end, bases (without the gaps), pieces."""
    own = [*row_id, "target", "orientation"]
    order = Window.partitionBy(*own).orderBy("start")
    near = (F.col("start") - F.lag("end").over(order) - 1 <= gap) & F.when(
        F.col("orientation") == 1, (F.col("target_start") - F.lag("target_end").over(order) - 1).between(0, gap)
    ).otherwise((F.lag("target_start").over(order) - F.col("target_end") - 1).between(0, gap))
    marked = pieces.withColumn("_new", F.coalesce((~near).cast("int"), F.lit(1)))
    runs = marked.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*own, "_run").agg(
        F.min("target_start").alias("target_start"), F.max("target_end").alias("target_end"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.count(F.lit(1)).alias("pieces")
    ).drop("_run")


def projected_models(exons: DataFrame, blocks: DataFrame, keys: Sequence[str], gap: int, width: int = JOIN_BIN) -> DataFrame:
    """gene_id, status, exons, whole, cut, lost, mapped, target, target_start, target_end: models through a map.

    exons: gene_id, keys, rank, start, end, coding (has coding bases). An exon is whole if one run of its pieces (joined over
    gaps of at most gap bases) holds all its bases, lost if nothing of it has a place, and cut otherwise. A model goes to
    the target that takes most of its bases (ties: the smaller name): complete if all exons are whole on it, coding if all
    with coding bases are, partial if some base is mapped, lost otherwise."""
    keys = list(keys)
    own = exons.select("gene_id", *keys, "rank", "start", "end", "coding")
    pieces = projected(own.withColumn("length", F.col("end") - F.col("start") + 1), blocks, keys, width)
    runs = joined_pieces(pieces.select("gene_id", "rank", "length", "start", "end", "target", "target_start", "target_end", "orientation"), ["gene_id", "rank", "length"], gap)
    totals = runs.groupBy("gene_id", "target").agg(F.sum("bases").alias("mapped"), F.min("target_start").alias("target_start"), F.max("target_end").alias("target_end"))
    best = totals.withColumn("_n", F.row_number().over(Window.partitionBy("gene_id").orderBy(F.desc("mapped"), "target"))).filter("_n = 1").drop("_n")
    states = runs.join(best.select("gene_id", "target"), ["gene_id", "target"]).groupBy("gene_id", "rank").agg(F.max(F.col("bases") == F.col("length")).alias("_whole"))
    facts = own.join(states, ["gene_id", "rank"], "left").groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("exons"), F.count_if("_whole").alias("whole"), F.count_if(~F.col("_whole")).alias("cut"), F.count_if(F.col("_whole").isNull()).alias("lost"),
        F.count_if(F.col("coding") & ~F.coalesce("_whole", F.lit(False))).alias("_broken"), F.count_if("coding").alias("_coding"),
    )
    status = F.when(F.col("whole") == F.col("exons"), "complete").when((F.col("_coding") > 0) & (F.col("_broken") == 0), "coding").when(F.col("mapped") > 0, "partial").otherwise("lost")
    return facts.join(best, "gene_id", "left").select("gene_id", status.alias("status"), "exons", "whole", "cut", "lost", F.coalesce("mapped", F.lit(0)).cast("long").alias("mapped"), "target", "target_start", "target_end")
