"""Clusters of genes and features: by span, by exon overlap, by gap, and their labels by evidence set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import forests, settled
from .intervals import SCAN_BIN, with_island

#: Bins of a scan in a zone.
ZONE_BINS = 64


def span_clusters(genes: DataFrame, keys: Sequence[str], gap: int = 0, scan_bin: int = SCAN_BIN) -> DataFrame:
    """genes with island, the cluster of overlapping spans along keys (leave strand out of keys to ignore it)."""
    return with_island(genes, keys, gap, scan_bin)


def exon_clusters(exons: DataFrame, keys: Sequence[str], gene_id: str = "gene_id", scan_bin: int = SCAN_BIN) -> DataFrame:
    """gene_id, cluster (its smallest gene): genes are linked if any of their exons overlap. Exons lie in every zone that
    they reach, where a stack of them makes one edge for each, not one for each pair. Most clusters lie in one zone, and a
    task settles what it holds; only what zones share is settled in rounds over all."""
    keys = list(keys)
    zone = lambda at: F.floor(at / (ZONE_BINS * scan_bin))
    zones = F.explode(F.sequence(zone(F.least("start", "end")), zone(F.greatest("start", "end")))).alias("_zone")
    known = reduce(and_, [F.col(c).isNotNull() for c in (*keys, "start", "end", gene_id)])
    rows = exons.filter(known).select(*keys, "start", "end", F.col(gene_id).alias("a"), zones)
    within = Window.partitionBy(*keys, "_zone").orderBy("start", "end")
    reached = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reached, F.lit(True))
    # each exon is linked to the gene that opened the stack it stands in
    hub = F.last(F.when(F.col("_opens"), F.col("a")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = rows.withColumn("_opens", opens).select("a", hub.alias("b"))
    return settled(forests(edges)).select(F.col("node").alias(gene_id), F.col("root").alias("cluster"))


def labelled(clusters: DataFrame, sets: DataFrame, set_name: str, gene_id: str = "gene_id") -> DataFrame:
    """clusters (gene_id, cluster) with n_genes, n_sets and way: two exactly if the cluster's genes come from two sets;
    with three or more it is one, as in the rules this follows."""
    joined = clusters.join(sets.select(gene_id, set_name), gene_id)
    facts = joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_genes"), F.count_distinct(set_name).alias("n_sets"))
    return joined.join(facts, "cluster").withColumn("way", F.when(F.col("n_sets") == 2, "two").otherwise("one"))
