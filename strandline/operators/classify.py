"""Labels by tiers and rule chains. The first rule that fits decides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .assembly import model_introns
from .graph import checkpointed
from .intervals import JOIN_BIN, covered_length, overlaps

#: Least coverage and identity of the tiers, best first.
STANDARD_TIERS = ((95, 90), (90, 80), (90, 60), (90, 40), (80, 20), (60, 20), (0, 0))
#: Least difference between supporting and other reads of an intron.
SUPPORT = ((8, "top"), (6, "high"), (4, "medium"), (2, "low"), (1, "weak"))


def tiers(rows: DataFrame, steps: Sequence[tuple[float, float]] = STANDARD_TIERS, prefix: str = "tier_") -> DataFrame:
    """rows with tier: the first of steps whose coverage and identity are reached."""
    label = None
    for n, (coverage, identity) in enumerate(steps, 1):
        rule = (F.col("coverage") >= coverage) & (F.col("identity") >= identity)
        label = F.when(rule, f"{prefix}{n}") if label is None else label.when(rule, f"{prefix}{n}")
    return rows.withColumn("tier", label)


def intron_support(rows: DataFrame, good: str, total: str) -> DataFrame:
    """rows with difference (supporting less other reads) and support."""
    difference = F.col(good) - (F.col(total) - F.col(good))
    label = None
    for least, name in SUPPORT:
        label = F.when(difference >= least, name) if label is None else label.when(difference >= least, name)
    return rows.withColumn("difference", difference).withColumn("support", label.otherwise("none"))


def model_evidence(exons: DataFrame, repeats: DataFrame, by: Sequence[str], shortest_real: int, width: int = JOIN_BIN) -> DataFrame:
    """gene_id, n_exons, introns, real, frameshift, intron_length, covered_exons, covered_introns of models (exons: gene_id,
    by, start, end): an intron over shortest_real bases is a real one, others are frameshifts; covered is the percent of
    bases under the union of repeats (0 without introns)."""
    by = list(by)
    gaps = model_introns(exons.select("gene_id", *by, "start", "end"))
    length = F.col("end") - F.col("start") + 1
    own = exons.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_exons"), F.sum(length).alias("_exon_length"))
    between = gaps.groupBy("gene_id").agg(F.count(F.lit(1)).alias("introns"), F.count_if(length > shortest_real).alias("real"), F.sum(length).alias("intron_length"))
    # exons and introns meet the repeats, which are merged once, in one join
    both = exons.select("gene_id", *by, "start", "end", F.lit(True).alias("_exon")).unionByName(gaps.withColumn("_exon", F.lit(False)))
    covered = covered_length(both, checkpointed(repeats.select(*by, "start", "end")), by, ["gene_id", "_exon"], width)
    of = lambda kind, name: F.sum(F.when(kind, F.col("covered"))).alias(name)
    under = covered.groupBy("gene_id").agg(of(F.col("_exon"), "_exon_bases"), of(~F.col("_exon"), "_intron_bases"))
    joined = own.join(between, "gene_id", "left").join(under, "gene_id", "left")
    whole = joined.fillna(0, ["introns", "real", "intron_length", "_exon_bases", "_intron_bases"])
    percent = lambda a, b: F.when(F.col(b) > 0, F.round(100 * F.col(a) / F.col(b), 4)).otherwise(0.0)
    return whole.select("gene_id", "n_exons", "introns", "real", (F.col("introns") - F.col("real")).alias("frameshift"), "intron_length", percent("_exon_bases", "_exon_length").alias("covered_exons"), percent("_intron_bases", "intron_length").alias("covered_introns"))


def covered_single_introns(exons: DataFrame, features: DataFrame, by: Sequence[str], shortest_real: int, most: float, pieces: int = 2, width: int = JOIN_BIN) -> DataFrame:
    """gene_id of models of which the first intron over shortest_real bases lies by over most percent under features of each
    of at least some pieces of evidence of its own (features: gene_id, hit, by, start, end); a piece's overlaps count once."""
    by = list(by)
    gaps = model_introns(exons.select("gene_id", *by, "start", "end")).filter(F.col("end") - F.col("start") + 1 > shortest_real)
    first = gaps.groupBy("gene_id", *by).agg(F.min(F.struct("start", "end")).alias("i")).select("gene_id", *by, "i.start", "i.end")
    # only what lies in the intron is merged: each stretch counts what no earlier one of its piece has reached
    pairs = overlaps(first, features.select("gene_id", "hit", *by, "start", "end").filter("hit IS NOT NULL"), ["gene_id", *by], width)
    inner = pairs.withColumns({"_low": F.greatest("start", "r_start"), "_high": F.least("end", "r_end")})
    earlier = Window.partitionBy("gene_id", *by, "r_hit").orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    added = F.greatest(F.col("_high") - F.greatest(F.col("_low") - 1, F.max("_high").over(earlier)), F.lit(0))
    shared = inner.withColumn("_added", added).groupBy("gene_id", "r_hit", "start", "end").agg(F.sum("_added").alias("_n"))
    return shared.filter(100 * F.col("_n") > most * (F.col("end") - F.col("start") + 1)).groupBy("gene_id").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") >= pieces).select("gene_id")


def pseudogenes(
    models: DataFrame, evidence: DataFrame, dodgy: DataFrame, blessed: Sequence[str], reads: Sequence[str], most_exon_cover: float, most_intron_cover: float, longest_introns: int,
    least_frameshift: int, least_real: int, most_frameshift: int, indeterminate: bool = True,
) -> DataFrame:
    """models (gene_id, biotype, ...) with call, by the first rule that fits. evidence: as model_evidence gives it; dodgy:
    gene_id of models whose single real intron evidence covers.

    single_exon: one exon, not under repeats and not of a blessed biotype. real: a biotype that begins with one of reads.
    pseudo: short introns in sum, frameshifts, real introns and repeats in introns all at their bounds; or all introns are
    frameshifts; or there are over most_frameshift. repeat: exons under repeats. indeterminate (if asked for): frameshifts
    or, for other than blessed biotypes, repeats in introns at their bounds. pseudo: one real intron, and it is dodgy."""
    joined = models.join(evidence, "gene_id").join(dodgy.select("gene_id", F.lit(True).alias("_dodgy")), "gene_id", "left")
    under = (F.col("covered_exons") > 0) & (F.col("covered_exons") >= most_exon_cover)
    holy = F.col("biotype").isin(*blessed)
    from_reads = reduce(lambda a, b: a | b, [F.col("biotype").startswith(r) for r in reads], F.lit(False))
    filled = F.col("covered_introns") >= most_intron_cover
    shifted = F.col("frameshift") >= least_frameshift
    call = (
        F.when((F.col("n_exons") == 1) & ~under & ~holy, "single_exon")
        .when(from_reads, "real")
        .when((F.col("intron_length") < longest_introns) & shifted & (F.col("real") >= least_real) & filled, "pseudo")
        .when((F.col("introns") > 0) & (F.col("frameshift") == F.col("introns")), "pseudo")
        .when(F.col("frameshift") > most_frameshift, "pseudo")
        .when(under, "repeat")
        .when(F.lit(indeterminate) & (shifted | (filled & ~holy)), "indeterminate")
        .when((F.col("real") == 1) & F.coalesce("_dodgy", F.lit(False)), "pseudo")
        .otherwise("real")
    )
    return joined.withColumn("call", call).drop("_dodgy")


def gene_vote(transcripts: DataFrame) -> DataFrame:
    """gene_id, call: real if any transcript is, else the commonest call of its transcripts, ties by name."""
    counts = transcripts.groupBy("gene_id", "call").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("gene_id").agg(
        F.when(F.max(F.col("call") == "real"), "real").otherwise(F.max_by("call", F.struct("n", "call"))).alias("call")
    )
