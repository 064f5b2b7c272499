"""Work units: regions, fixed windows, padded regions and batches."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grouped import Group, in_groups


def windows(regions: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """region, start, end: windows of size over [1, length]; each begins overlap bases before the one before ends."""
    step = size - overlap
    starts = F.sequence(F.lit(1).cast("long"), F.greatest(F.col("length") - overlap, F.lit(1)), F.lit(step).cast("long"))
    return regions.select("region", "length", F.explode(starts).alias("start")).select("region", "start", F.least(F.col("start") + size - 1, F.col("length")).alias("end"))


def padded(rows: DataFrame, pad: int, length: str) -> DataFrame:
    """rows widened on both sides within [1, length]."""
    return rows.withColumns({"start": F.greatest(F.col("start") - pad, F.lit(1)), "end": F.least(F.col("end") + pad, F.col(length))})


def stranded(regions: DataFrame) -> DataFrame:
    return regions.withColumn("strand", F.explode(F.array(F.lit(1), F.lit(-1))))


def count_batches(rows: DataFrame, key: str, size: int, group: Sequence[str] = ()) -> DataFrame:
    """rows with batch, size rows each in order of key within each group. Without groups, rows are numbered through
    buckets of the key's hash, so that no single task sorts them all; batches then follow buckets."""
    if group:
        at = F.row_number().over(Window.partitionBy(*group).orderBy(key)) - 1
        return rows.withColumn("batch", F.floor(at / size).cast("long"))
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(1024)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_bucket", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return bucketed.join(F.broadcast(before), "_bucket").withColumn("batch", F.floor(at / size).cast("long")).drop("_bucket", "_before")


def balanced_batches(rows: DataFrame, group: Sequence[str], length: str, key: str, target: int) -> DataFrame:
    """rows with batch: in order of length then key, a batch closes when the summed length has passed a multiple of
    target."""
    order = Window.partitionBy(*group).orderBy(length, key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("batch", F.floor(F.coalesce(F.sum(length).over(order), F.lit(0)) / target).cast("long"))


def neighbours(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """rows with previous_gap and next_gap: bases to the row before and after along each key."""
    window = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumns({"previous_gap": F.col("start") - F.lag("end").over(window) - 1, "next_gap": F.lead("start").over(window) - F.col("end") - 1})


def low_coverage_cuts(regions: DataFrame, runs: DataFrame, window: int, step: int, first: int, least_bases: int, least_depth: int) -> DataFrame:
    """region, start, end: regions (region, length) cut where reads are few. runs: region, start, end, depth, of stretches of
    equal depth.

    A window begins at first and moves by step while its end lies inside the region. It is low if fewer than least_bases of
    the bases from one before its start to one before its end have a depth over least_depth. The region is cut behind the
    middle of a low window, and the next window begins first bases after the cut; a rest of no more than first bases is the
    last slice. Windows count bases in runs, so nothing is laid out base by base; a task holds one region's runs of depth
    over the bound, joined where they touch. A missing region is one region, as everywhere in groups."""
    deep = runs.filter(F.col("depth") > least_depth).select(F.col("region").alias("_region"), "start", "end")
    rows = regions.select("region", "length", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))
    rows = rows.unionByName(deep.join(regions, F.col("_region").eqNullSafe(F.col("region"))).select("region", "length", "start", "end"))
    kind = dict(regions.dtypes)["region"]

    def run(group: Group) -> Iterator[tuple]:
        region, length = group["region"][0], group["length"][0]
        # the row of the region itself comes first; a missing number may come as one that is not equal to itself
        spans = [(int(s), int(e)) for s, e in zip(group["start"], group["end"], strict=True) if s is not None and s == s]
        starts, through = [s for s, _ in spans], [0]
        for s, e in spans:
            through.append(through[-1] + e - s + 1)

        def bases(upto: int) -> int:
            """Deep bases from the region's start to upto."""
            at = bisect_right(starts, upto)
            return through[at] - max(0, spans[at - 1][1] - upto) if at else 0

        begin, at = 1, first
        while at < length - window:
            if bases(at + window - 2) - bases(at - 2) >= least_bases:
                at += step
                continue
            middle = (2 * at + window) // 2
            yield region, begin, middle
            begin = middle + 1
            if begin >= length:
                return
            if begin + first >= length:
                break
            at = middle + first
        yield region, begin, length

    return in_groups(rows, ["region"], ["start", "end"], run, f"region {kind}, start long, end long")
