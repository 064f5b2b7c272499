"""Filters by name: thresholds, lists, family cutoffs and structural rules. Filters are functions of DataFrames in a
registry, so a configuration can name them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import introns

REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def register(name: str):
    def keep(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[name] = function
        return function

    return keep


def apply_named(rows: DataFrame, name: str, **parameters) -> DataFrame:
    """The registered filter of that name, applied with the parameters."""
    return REGISTRY[name](rows, **parameters)


@register("thresholds")
def thresholds(rows: DataFrame, limits: Mapping[str, str]) -> DataFrame:
    """Rows for which all limits hold: "5" asks for more than 5, "lessthan 5" for less."""

    def rule(name: str, limit: str) -> Column:
        word, _, number = limit.rpartition(" ")
        return F.col(name) < float(number) if word == "lessthan" else F.col(name) > float(number)

    return rows.filter(reduce(lambda a, b: a & b, [rule(n, v) for n, v in limits.items()]))


@register("biotypes")
def of_biotypes(rows: DataFrame, names: list[str], column: str = "biotype") -> DataFrame:
    return rows.filter(F.col(column).isin(*names))


@register("without_listed")
def without_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; Spark broadcasts the list only while it is small."""
    return rows.join(listed.select(key).distinct(), key, "left_anti")


@register("over_cutoff")
def over_cutoff(rows: DataFrame, cutoffs: DataFrame, key: str, score: str, default: float) -> DataFrame:
    """Rows whose score is over their family's cutoff, or over default where the family has none."""
    joined = rows.join(cutoffs.select(key, F.col("cutoff").alias("_cutoff")), key, "left")
    return joined.filter(F.col(score) > F.coalesce("_cutoff", F.lit(default))).drop("_cutoff")


@register("supported")
def supported(rows: DataFrame, min_coverage: float, min_identity: float) -> DataFrame:
    return rows.filter((F.col("coverage") >= min_coverage) & (F.col("identity") >= min_identity))


@register("exon_count")
def exon_count(models: DataFrame, least: int = 1, most: int | None = None) -> DataFrame:
    kept = models.filter(F.size("exons") >= least)
    return kept if most is None else kept.filter(F.size("exons") <= most)


@register("intron_lengths")
def intron_lengths(models: DataFrame, longest: int) -> DataFrame:
    """Models whose introns are all shorter than longest."""
    return models.filter(F.forall(introns(F.col("exons")), lambda i: i["end"] - i["start"] + 1 < longest))


@register("rough_models")
def rough_models(models: DataFrame, min_exons: int, min_length: int, min_single: int, min_span: float, long_enough: int) -> DataFrame:
    """Models with enough exons and bases; single exons need min_single; a model shorter than long_enough must span
    min_span times its bases."""
    length = F.aggregate("exons", F.lit(0).cast("bigint"), lambda a, e: a + e["end"] - e["start"] + 1)
    span = (F.col("end") - F.col("start") + 1) / length
    enough = (F.size("exons") >= min_exons) & (length >= min_length)
    single = (F.size("exons") > 1) | (length >= min_single)
    return models.filter(enough & single & ((span >= min_span) | (length >= long_enough)))


@register("valid_structure")
def valid_structure(models: DataFrame) -> DataFrame:
    """Models with exons of positive length, in order, and not overlapping."""
    fine = F.forall("exons", lambda e: e["start"] <= e["end"])
    return models.filter((F.size("exons") > 0) & fine & F.forall(introns(F.col("exons")), lambda i: i["end"] >= i["start"] - 1))
