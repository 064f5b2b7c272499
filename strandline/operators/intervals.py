"""Interval algebra over closed intervals of (keys, start, end).

Merging and depth are prefix scans along each key. One key may hold most rows, so a scan has two levels: positions are
cut into bins, rows are scanned within (key, bin), and only one row for each bin is scanned along the key. Overlap joins
are equi-joins on bins with the overlap as a residual; a pair is kept in the first bin that both share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the bins in positions; choose near the median length for joins, far over it for scans.
SCAN_BIN = 4096
JOIN_BIN = 1024


def _div(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width)).cast("long")


def with_island(rows: DataFrame, keys: Sequence[str], gap: int = 0, scan_bin: int = SCAN_BIN, clamp: bool = False) -> DataFrame:
    """rows with island: numbers from 1 along each key. A row starts an island if its start lies more than gap beyond
    every earlier end; with gap 0, touching intervals (end + 1 = start) stay apart. clamp lifts starts under 1 to 1."""
    keys = list(keys)
    start = F.greatest(F.col("start"), F.lit(1)) if clamp else F.col("start")
    rows = rows.withColumn("start", start).withColumn("_bin", _div(F.col("start"), scan_bin))
    bins = rows.groupBy(*keys, "_bin").agg(F.max("end").alias("_reach"))
    along = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.select(*keys, "_bin", F.max("_reach").over(along).alias("_before"))
    within = Window.partitionBy(*keys, "_bin").orderBy("start", "end")
    earlier = F.greatest(F.col("_before"), F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.coalesce((F.col("start") > earlier + gap).cast("int"), F.lit(1))
    flagged = _keyed_join(rows, before, [*keys, "_bin"]).withColumn("_opens", opens)
    opened = flagged.groupBy(*keys, "_bin").agg(F.sum("_opens").alias("_n"))
    offsets = opened.select(*keys, "_bin", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_offset"))
    # by range: rows of equal start and end get one number, whichever of them was sorted first and opened the island
    own = F.sum("_opens").over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = _keyed_join(flagged, offsets, [*keys, "_bin"]).withColumn("island", (F.col("_offset") + own).cast("long"))
    return numbered.drop("_bin", "_before", "_opens", "_offset")


def _keyed_join(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(small, on)


def merged(rows: DataFrame, keys: Sequence[str], gap: int = 0, scan_bin: int = SCAN_BIN, clamp: bool = False) -> DataFrame:
    """keys, start, end, n: one row for each island."""
    keys = list(keys)
    islands = with_island(rows.select(*keys, "start", "end"), keys, gap, scan_bin, clamp)
    return islands.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("island")


def gaps(rows: DataFrame, keys: Sequence[str], scan_bin: int = SCAN_BIN) -> DataFrame:
    """keys, start, end of the stretches between neighbouring islands of a key."""
    islands = merged(rows, keys, scan_bin=scan_bin)
    after = F.lead("start").over(Window.partitionBy(*keys).orderBy("start"))
    return islands.withColumn("_next", after).filter(F.col("_next") > F.col("end") + 1).select(*keys, (F.col("end") + 1).alias("start"), (F.col("_next") - 1).alias("end"))


def _binned(rows: DataFrame, width: int) -> DataFrame:
    return rows.withColumn("_bin", F.explode(F.sequence(_div(F.col("start"), width), _div(F.col("end"), width))))


def overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = JOIN_BIN, pad: int = 0) -> DataFrame:
    """All pairs of overlapping rows. right's columns other than keys get the prefix r_. pad widens right on both sides."""
    keys = list(keys)
    if pad:
        right = right.withColumns({"_s": F.col("start"), "_e": F.col("end"), "start": F.greatest(F.col("start") - pad, F.lit(1)), "end": F.col("end") + pad})
    right = _binned(right, width)
    right = right.select(*keys, "_bin", *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in (*keys, "_bin")])
    pairs = _binned(left, width).join(right, [*keys, "_bin"])
    first_shared = _div(F.greatest(F.col("start"), F.col("r_start")), width)
    kept = pairs.filter((F.col("start") <= F.col("r_end")) & (F.col("end") >= F.col("r_start")) & (F.col("_bin") == first_shared)).drop("_bin")
    if pad:
        kept = kept.withColumn("r_start", F.col("r__s")).withColumn("r_end", F.col("r__e")).drop("r__s", "r__e")
    return kept


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """Distinct left ids with a row that overlaps a row of right. right is merged first, which loses no overlap and
    bounds the pairs a base can make to one."""
    keys, left_id = list(keys), list(left_id)
    blocks = merged(right, keys).select(*keys, "start", "end")
    return overlaps(left.select(*dict.fromkeys([*keys, "start", "end", *left_id])), blocks, keys, width).select(*left_id).distinct()


def semi_overlap(rows: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """rows whose id has an interval in left that overlaps one of right."""
    return rows.join(overlapping(left, right, keys, left_id, width), list(left_id), "left_semi")


def anti_overlap(rows: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """rows whose id has no interval in left that overlaps one of right."""
    return rows.join(overlapping(left, right, keys, left_id, width), list(left_id), "left_anti")


def covered_length(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """left_id, covered: bases of each id's intervals (counted by interval) under the union of right."""
    keys, left_id = list(keys), list(left_id)
    blocks = merged(right, keys).select(*keys, "start", "end")
    pairs = overlaps(left.select(*dict.fromkeys([*keys, "start", "end", *left_id])), blocks, keys, width)
    shared = F.least("end", "r_end") - F.greatest("start", "r_start") + 1
    return pairs.groupBy(*left_id).agg(F.sum(shared).alias("covered"))


def subtracted(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """row_id, keys, start, end: what is left of each interval of left outside the union of right."""
    keys, row_id = list(keys), list(row_id)
    blocks = merged(right, keys).select(*keys, "start", "end")
    own = [*dict.fromkeys([*row_id, *keys])]
    base = left.select(*own, "start", "end").distinct()
    cuts = overlaps(base, blocks, keys, width).groupBy(*own, "start", "end").agg(F.array_sort(F.collect_list(F.struct("r_start", "r_end"))).alias("cuts"))
    joined = base.join(cuts, [*own, "start", "end"], "left")
    lows = F.concat(F.array(F.col("start")), F.transform("cuts", lambda c: c["r_end"] + 1))
    highs = F.concat(F.transform("cuts", lambda c: c["r_start"] - 1), F.array(F.col("end")))
    pieces = F.filter(F.zip_with(lows, highs, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda p: p["start"] <= p["end"])
    whole = F.array(F.struct(F.col("start"), F.col("end")))
    return joined.select(*own, F.explode(F.when(F.col("cuts").isNull(), whole).otherwise(pieces)).alias("p")).select(*own, "p.start", "p.end")


def overlap_parts(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], values: Sequence[str], scan_bin: int = SCAN_BIN) -> DataFrame:
    """left_id, start, end, part, values: for each interval of left terms that add up to the sums of right's values over the
    intervals that overlap it; equal left rows have equal terms. No pair is made: what starts up to the interval's end, less
    what ends before its start, by scans in two levels. An interval whose ends lie in one bin has one term (part 0), any
    other has one for its end (1) and one for its start (2). Intervals without a start or an end have none."""
    keys, values = list(keys), list(values)
    own = [c for c in left_id if c not in (*keys, "start", "end")]

    def binned(rows: DataFrame, asks: bool, up: Column, down: Column) -> DataFrame:
        columns = [F.col(v).cast("double").alias(f"_{v}") for v in values] if not asks else [F.lit(0.0).alias(f"_{v}") for v in values]
        names = [F.col(c) if asks else F.lit(None).cast(dict(left.dtypes)[c]).alias(c) for c in own]
        of_up, of_down = _div(up, scan_bin), _div(down, scan_bin)
        bins = F.explode(F.when(of_up == of_down, F.array(of_up)).otherwise(F.array(of_up, of_down))).alias("_bin")
        return rows.filter("start IS NOT NULL AND end IS NOT NULL").select(*keys, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.lit(asks).alias("_asks"), *columns, *names, bins)

    every = binned(left, True, F.col("end"), F.col("start")).unionByName(binned(right, False, F.col("start"), F.col("end") + 1))
    # places in the scan of starts and in that of ends, as far as they lie in the bin
    up, down = F.when(F.col("_asks"), F.col("end")).otherwise(F.col("start")), F.when(F.col("_asks"), F.col("start")).otherwise(F.col("end") + 1)
    sides = {"_up": F.when(_div(up, scan_bin) == F.col("_bin"), up), "_down": F.when(_div(down, scan_bin) == F.col("_bin"), down)}
    counted = lambda side, v: F.when(F.col(side).isNotNull(), F.col(f"_{v}")).otherwise(0.0)
    bins = every.withColumns(sides).groupBy(*keys, "_bin").agg(*[F.sum(counted(side, v)).alias(f"{side}_{v}") for side in sides for v in values])
    along = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.select(*keys, "_bin", *[F.coalesce(F.sum(f"{side}_{v}").over(along), F.lit(0.0)).alias(f"_before{side}_{v}") for side in sides for v in values])
    rows = every.repartition(*keys, "_bin").withColumns(sides)
    for side in sides:
        within = Window.partitionBy(*keys, "_bin").orderBy(side).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({f"_sum{side}_{v}": F.sum(counted(side, v)).over(within) for v in values})
    found = rows.filter("_asks").join(before, [*keys, "_bin"])
    term = lambda side, v: F.when(F.col(side).isNotNull(), F.col(f"_before{side}_{v}") + F.col(f"_sum{side}_{v}")).otherwise(0.0)
    part = F.when(F.col("_up").isNull(), 2).when(F.col("_down").isNull(), 1).otherwise(0)
    return found.select(*dict.fromkeys([*left_id, "start", "end"]), part.alias("part"), *[(term("_up", v) - term("_down", v)).alias(v) for v in values])


def overlap_sums(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], values: Sequence[str], scan_bin: int = SCAN_BIN) -> DataFrame:
    """left_id, values: for each interval of left the sums of right's values over the intervals that overlap it, by the terms
    of overlap_parts()."""
    left = left.select(*dict.fromkeys([*keys, "start", "end", *left_id])).distinct()
    found = overlap_parts(left, right, keys, left_id, values, scan_bin)
    return found.groupBy(*left_id).agg(*[F.sum(v).alias(v) for v in values])


def depth(rows: DataFrame, keys: Sequence[str], scan_bin: int = SCAN_BIN) -> DataFrame:
    """keys, start, end, depth: maximal runs of positions with equal depth over 0 between boundaries of rows. Rows without a
    start or an end cover nothing."""
    keys = list(keys)
    rows = rows.filter("start IS NOT NULL AND end IS NOT NULL")
    edge = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("step"))))
    edges = rows.select(*keys, edge.alias("e")).groupBy(*keys, F.col("e.at").alias("at")).agg(F.sum("e.step").alias("step"))
    edges = edges.withColumn("_bin", _div(F.col("at"), scan_bin))
    bins = edges.groupBy(*keys, "_bin").agg(F.sum("step").alias("_sum"), F.min("at").alias("_first"))
    along = Window.partitionBy(*keys).orderBy("_bin")
    offsets = bins.select(
        *keys, "_bin", F.coalesce(F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(along).alias("_after")
    )
    within = Window.partitionBy(*keys, "_bin").orderBy("at")
    level = F.col("_before") + F.sum("step").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a missing key is a key of its own
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    own = [F.col(f"e.{c}") for c in (*keys, "_bin", "at", "step")]
    joined = edges.alias("e").join(offsets.alias("o"), reduce(and_, same, F.col("e._bin") == F.col("o._bin"))).select(*own, "_before", "_after")
    runs = joined.select(*keys, F.col("at").alias("start"), (F.coalesce(F.lead("at").over(within), F.col("_after")) - 1).alias("end"), level.cast("long").alias("depth"))
    return runs.filter("depth > 0")


def saturated_zones(rows: DataFrame, keys: Sequence[str], least_depth: int, least_length: int = 1, scan_bin: int = SCAN_BIN) -> DataFrame:
    """keys, start, end, total, mean: stretches with depth of least_depth or more at every base and least_length bases;
    total is the summed depth."""
    keys = list(keys)
    high = depth(rows, keys, scan_bin).filter(F.col("depth") >= least_depth)
    runs = with_island(high, keys, gap=1, scan_bin=scan_bin)
    zones = runs.groupBy(*keys, "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("depth") * (F.col("end") - F.col("start") + 1)).alias("total")
    )
    length = F.col("end") - F.col("start") + 1
    return zones.filter(length >= least_length).select(*keys, "start", "end", "total", F.round(F.col("total") / length, 4).alias("mean"))
