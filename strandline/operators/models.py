"""Gene models as rows with an array of exons (rank, start, end): introns, chains, splits, trims and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def introns(exons: Column) -> Column:
    """Array of start, end of the stretches between neighbouring exons in order of start."""
    ordered = F.array_sort(F.transform(exons, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"))))
    after = F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0)))
    return F.zip_with(F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))), after, lambda a, b: F.struct((a["end"] + 1).alias("start"), (b["start"] - 1).alias("end")))


def chain_key(spans: Column) -> Column:
    """start:end of each span, joined by colons."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ":")


def total_length(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"] + 1)


def split_on_introns(models: DataFrame, longest: int) -> DataFrame:
    """A part of each model for every run of exons without an intron over longest: gene_id, part, exons, start, end."""
    exon = F.posexplode("exons").alias("at", "e")
    rows = models.select("gene_id", "region", "strand", exon).select("gene_id", "region", "strand", "e.*")
    order = Window.partitionBy("gene_id").orderBy("start", "rank")
    cut = (F.col("start") - F.lag("end").over(order) - 1 > longest).cast("int")
    parts = rows.withColumn("part", F.sum(F.coalesce(cut, F.lit(0))).over(order) + 1)
    return parts.groupBy("gene_id", "region", "strand", "part").agg(
        F.array_sort(F.collect_list(F.struct("rank", "start", "end"))).alias("exons"), F.min("start").alias("start"), F.max("end").alias("end")
    )


def trimmed_ends(exons: Column, shortest: int) -> Column:
    """Exons from the first to the last that is shortest bases or longer; none if all are shorter."""
    long_at = F.filter(F.sequence(F.lit(1), F.size(exons)), lambda i: F.element_at(exons, i)["end"] - F.element_at(exons, i)["start"] + 1 >= shortest)
    return F.when(F.size(long_at) > 0, F.slice(exons, F.array_min(long_at), F.array_max(long_at) - F.array_min(long_at) + 1)).otherwise(F.slice(exons, 1, 0))


def clipped(exons: Column, low: Column, high: Column) -> Column:
    """Exons cut to [low, high], without those outside."""
    inside = F.filter(exons, lambda e: (e["start"] <= high) & (e["end"] >= low))
    return F.transform(inside, lambda e: F.struct(e["rank"].alias("rank"), F.greatest(e["start"], low).alias("start"), F.least(e["end"], high).alias("end")))


def with_phases(exons: DataFrame) -> DataFrame:
    """Exon rows with phase and end_phase: the phase runs on as (length + phase) mod 3 in order of rank."""
    order = Window.partitionBy("gene_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("end") - F.col("start") + 1
    phase = F.coalesce(F.sum(length).over(order), F.lit(0)) % 3
    return exons.withColumn("phase", phase.cast("int")).withColumn("end_phase", ((F.col("phase") + length) % 3).cast("int"))


def cdna_position(exons: DataFrame) -> DataFrame:
    """Exon rows with cdna_start, cdna_end: their bases in the joined model."""
    through = Window.partitionBy("gene_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(through), F.lit(0))
    return exons.withColumn("cdna_start", before + 1).withColumn("cdna_end", before + F.col("end") - F.col("start") + 1)


def exon_pair_support(exons: DataFrame, least: int) -> DataFrame:
    """gene_id, pairs, support (the least number of genes that share one of its exon pairs), stays (support >= least)."""
    order = Window.partitionBy("gene_id").orderBy("start", "rank")
    length, gap = F.col("end") - F.col("start") + 1, F.lead("start").over(order) - F.col("end") - 1
    pairs = exons.withColumns({"gap": gap, "length": length, "next": F.lead("end").over(order) - F.lead("start").over(order) + 1}).filter("gap IS NOT NULL")
    shared = pairs.groupBy("region", "strand", "gap", "length", "next").agg(F.count_distinct("gene_id").alias("genes"))
    joined = pairs.join(shared, ["region", "strand", "gap", "length", "next"])
    return joined.groupBy("gene_id").agg(F.count(F.lit(1)).alias("pairs"), F.min("genes").alias("support")).withColumn("stays", F.col("support") >= least)


def consensus_score(exons: DataFrame) -> DataFrame:
    """Exon rows with n_same (genes with the same exon), n_over (genes whose exons overlap it) and their quotient."""
    from .intervals import overlaps

    same = exons.groupBy("region", "strand", "start", "end").agg(F.count_distinct("gene_id").alias("n_same"))
    own = exons.select("gene_id", "rank", "region", "strand", "start", "end")
    over = overlaps(own, own.select("gene_id", "region", "strand", "start", "end"), ["region", "strand"]).groupBy("gene_id", "rank").agg(F.count_distinct("r_gene_id").alias("n_over"))
    joined = own.join(same, ["region", "strand", "start", "end"]).join(over, ["gene_id", "rank"])
    return joined.withColumn("quotient", F.round(F.col("n_same") / F.col("n_over"), 6))


def unique_exons(exons: DataFrame) -> DataFrame:
    """Exon rows with exon_id, equal for equal (region, strand, start, end): a hash, so no ordering of all exons is needed."""
    return exons.withColumn("exon_key", F.concat_ws(":", "region", "strand", "start", "end"))


def flattened(models: DataFrame) -> DataFrame:
    return models.select(*[c for c in models.columns if c != "exons"], F.explode("exons").alias("e")).select("*", "e.*").drop("e")
