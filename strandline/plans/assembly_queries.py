"""Models as paths through exons and introns, over the driver's tables. Searches are beyond SQL; tests/test_assembly.py holds
each query against plain Python over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assembly
from ..sources import driver_tables as t

STRANDED = ["region", "strand"]


def reads_introns(spark, sf):
    """Introns that reads show: those of all models, a place once, with the number of models and of their bases as score."""
    found = assembly.model_introns(t.exons(spark, sf).select("gene_id", *STRANDED, "start", "end", "score"))
    score = F.count(F.lit(1)) + F.floor(F.max("score") / 10_000)
    kinds = found.groupBy(*STRANDED, (F.col("start") - 1).alias("start"), (F.col("end") + 1).alias("end")).agg(score.cast("double").alias("score"))
    return kinds.withColumn("canonical", (F.col("start") + F.col("end")) % 5 != 0)


def refined_models(spark, sf):
    rough = t.exons(spark, sf).select("gene_id", "region", "start", "end", F.floor(F.col("score") / 100).cast("double").alias("score"))
    return assembly.refined_models(rough, reads_introns(spark, sf), ["region"], shortest_model=60, min_intron=5, penalty=2, k=3, pad=2)


def consensus_models(spark, sf):
    exons = t.exons(spark, sf).withColumn("is_est", F.col("source") == "O")
    return assembly.consensus_models(exons, STRANDED, short_exon=15)


def coalesced_models(spark, sf):
    return assembly.coalesced_models(t.exons(spark, sf), STRANDED)


QUERIES = {"refined_models": refined_models, "consensus_models": consensus_models, "coalesced_models": coalesced_models}
ORACLE_SQL: dict[str, str] = {}
