"""Interval and cluster operators over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters, intervals
from ..sources import driver_tables as t

BY_REGION = ["region"]
STRANDED = ["region", "strand"]
#: Features stand densely over some 2,500 positions; exons lie over some 50,000.
DENSE, SPARSE = 64, 1024

_ISLANDS = """
marked AS (
  SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY region ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens
  FROM features
), islands AS (
  SELECT region, island, min("start") AS "start", max("end") AS "end", count(*) AS n FROM (
    SELECT *, sum(opens) OVER (PARTITION BY region ORDER BY "start", "end" RANGE UNBOUNDED PRECEDING) AS island FROM marked)
  GROUP BY region, island
)"""


def merged_blocks(spark, sf):
    return intervals.merged(t.features(spark, sf), BY_REGION, scan_bin=DENSE)


def masked_bases_by_region(spark, sf):
    blocks = intervals.merged(t.features(spark, sf), BY_REGION, scan_bin=DENSE)
    facts = blocks.groupBy("region").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(F.col("end") - F.col("start") + 1).alias("masked"), F.max("end").alias("total")
    )
    return facts.withColumn("ratio", F.round(100 * F.col("masked") / F.col("total"), 4))


def intergenic_gaps(spark, sf):
    return intervals.gaps(t.features(spark, sf), BY_REGION, scan_bin=DENSE)


def exon_overlap_pairs(spark, sf):
    exons = t.exons(spark, sf).select("gene_id", "rank", "region", "strand", "start", "end")
    pairs = intervals.overlaps(exons, exons, STRANDED, width=SPARSE).filter("gene_id < r_gene_id")
    shared = F.least("end", "r_end") - F.greatest("start", "r_start") + 1
    return pairs.groupBy("gene_id", F.col("r_gene_id").alias("other_id")).agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(shared).alias("shared"))


_PAIRS = """
pairs AS (
  SELECT a.gene_id AS gene_id, b.gene_id AS other_id, least(a."end", b."end") - greatest(a."start", b."start") + 1 AS shared
  FROM exons a JOIN exons b ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start" AND a.gene_id <> b.gene_id
)"""


def exons_clear_of_features(spark, sf):
    exons = t.exons(spark, sf)
    high = exons.filter("biotype = '1-URGENT'").select(*STRANDED, "start", "end")
    rest = exons.filter("biotype <> '1-URGENT'")
    genes = rest.select("gene_id", "region", "strand").distinct()
    return intervals.anti_overlap(genes, rest, high, STRANDED, ["gene_id"], SPARSE)


def exons_hit_by_features(spark, sf):
    exons = t.exons(spark, sf)
    high = exons.filter("biotype = '1-URGENT'").select(*STRANDED, "start", "end")
    rest = exons.filter("biotype <> '1-URGENT'")
    genes = rest.select("gene_id", "region", "strand").distinct()
    return intervals.semi_overlap(genes, rest, high, STRANDED, ["gene_id"], SPARSE)


def _clear(negated):
    return f"""
WITH {t.EXONS}
SELECT DISTINCT gene_id, region, strand FROM exons e WHERE biotype <> '1-URGENT' AND gene_id {negated} IN (
  SELECT a.gene_id FROM exons a JOIN exons b ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start"
  WHERE a.biotype <> '1-URGENT' AND b.biotype = '1-URGENT')
"""


def repeat_coverage_of_genes(spark, sf):
    exons = t.exons(spark, sf).select("gene_id", "region", "start", "end")
    repeats = t.features(spark, sf).filter("flag = 'R'").select("region", "start", "end")
    lengths = exons.groupBy("gene_id").agg(F.sum(F.col("end") - F.col("start") + 1).alias("length"))
    covered = intervals.covered_length(exons, repeats, BY_REGION, ["gene_id"], SPARSE)
    joined = lengths.join(covered, "gene_id", "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return joined.withColumn("percent", F.round(100 * F.col("covered") / F.col("length"), 4))


def exons_less_repeats(spark, sf):
    exons = t.exons(spark, sf).select("gene_id", "rank", "region", "start", "end")
    repeats = t.features(spark, sf).filter("flag = 'R'").select("region", "start", "end")
    left = intervals.subtracted(exons, repeats, BY_REGION, ["gene_id", "rank"], SPARSE)
    return left.groupBy("gene_id", "rank").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.min("start").alias("first"), F.max("end").alias("last"))


def depth_histogram(spark, sf):
    runs = intervals.depth(t.features(spark, sf), BY_REGION, DENSE)
    return runs.groupBy("region", "depth").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


_DEPTH = """
steps AS (
  SELECT region, pos, sum(step) AS step FROM (
    SELECT region, "start" AS pos, 1 AS step FROM features UNION ALL SELECT region, "end" + 1, -1 FROM features) GROUP BY region, pos
), runs AS (
  SELECT region, pos AS "start", lead(pos) OVER (PARTITION BY region ORDER BY pos) - 1 AS "end",
    (sum(step) OVER (PARTITION BY region ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS depth
  FROM steps
)"""


def saturated_zones(spark, sf):
    return intervals.saturated_zones(t.features(spark, sf), BY_REGION, least_depth=3, least_length=5, scan_bin=DENSE)


def read_clusters_by_gap(spark, sf):
    reads = clusters.span_clusters(t.reads(spark, sf), BY_REGION, gap=3600, scan_bin=86400)
    return reads.groupBy("region", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("reads"), F.count_distinct("biotype").alias("biotypes")
    )


def span_clusters_by_strand(spark, sf):
    genes = t.transcripts(spark, sf).drop("exons")
    found = clusters.span_clusters(genes, STRANDED, scan_bin=SPARSE)
    return found.groupBy(*STRANDED, "island").agg(F.count(F.lit(1)).alias("genes"), F.min("gene_id").alias("first_gene"), F.min("start").alias("start"), F.max("end").alias("end"))


def exon_overlap_clusters(spark, sf):
    return clusters.exon_clusters(t.exons(spark, sf), STRANDED, scan_bin=SPARSE)


_COMPONENTS = f"""
WITH RECURSIVE {t.EXONS.strip()}, edges AS (
  SELECT DISTINCT a.gene_id AS a, b.gene_id AS b FROM exons a JOIN exons b
    ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start"
), reach AS (
  SELECT a AS gene_id, b AS other FROM edges
  UNION SELECT reach.gene_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
), roots AS (
  SELECT gene_id, min(other) AS cluster FROM reach GROUP BY gene_id
)"""


def cluster_labels(spark, sf):
    exons = t.exons(spark, sf)
    found = clusters.exon_clusters(exons, STRANDED, scan_bin=SPARSE)
    return clusters.labelled(found, exons.select("gene_id", "source").distinct(), "source").select("gene_id", "cluster", "n_genes", "n_sets", "way")


def padded_neighbours(spark, sf):
    genes = t.transcripts(spark, sf).select("gene_id", "region", "start", "end", "strand")
    pairs = intervals.overlaps(genes, genes, BY_REGION, width=SPARSE, pad=50).filter("gene_id <> r_gene_id AND strand <> r_strand")
    return pairs.groupBy("gene_id").agg(F.count(F.lit(1)).alias("near"), F.min("r_gene_id").alias("first_near"))


def single_exon_in_span(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("n", F.size("exons")).drop("exons")
    single = genes.filter("n = 1").select("gene_id", *STRANDED, "start", "end")
    pairs = intervals.overlaps(single, genes.select("gene_id", *STRANDED, "start", "end"), STRANDED, SPARSE)
    return pairs.groupBy("gene_id").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1")


def repeat_free_windows(spark, sf):
    """Fixed windows of a region, each with the bases under features."""
    blocks = intervals.merged(t.features(spark, sf), BY_REGION, scan_bin=DENSE)
    tops = blocks.groupBy("region").agg(F.max("end").alias("length"))
    starts = F.explode(F.sequence(F.lit(1).cast("long"), F.col("length"), F.lit(500).cast("long"))).alias("start")
    windows = tops.select("region", "length", starts).withColumn("end", F.least(F.col("start") + 499, F.col("length"))).drop("length")
    covered = intervals.covered_length(windows.withColumn("window", F.col("start")), blocks.select("region", "start", "end"), BY_REGION, ["region", "window"], 512)
    joined = windows.join(covered.withColumnRenamed("window", "start"), ["region", "start"], "left")
    return joined.withColumn("covered", F.coalesce("covered", F.lit(0)))


QUERIES = {
    "merged_blocks": merged_blocks,
    "masked_bases_by_region": masked_bases_by_region,
    "intergenic_gaps": intergenic_gaps,
    "exon_overlap_pairs": exon_overlap_pairs,
    "overlap_anti_join": exons_clear_of_features,
    "overlap_semi_join": exons_hit_by_features,
    "repeat_coverage_of_genes": repeat_coverage_of_genes,
    "interval_subtraction": exons_less_repeats,
    "depth_histogram": depth_histogram,
    "saturated_zones": saturated_zones,
    "read_clusters_by_gap": read_clusters_by_gap,
    "span_clusters_by_strand": span_clusters_by_strand,
    "exon_overlap_clusters": exon_overlap_clusters,
    "cluster_labels": cluster_labels,
    "padded_neighbours": padded_neighbours,
    "single_exon_in_span": single_exon_in_span,
    "window_coverage": repeat_free_windows,
}

ORACLE_SQL = {
    "merged_blocks": f'WITH {t.FEATURES}, {_ISLANDS} SELECT region, "start", "end", n FROM islands',
    "masked_bases_by_region": f"""WITH {t.FEATURES}, {_ISLANDS}
SELECT region, count(*) AS blocks, sum("end" - "start" + 1)::BIGINT AS masked, max("end") AS total,
  round(100 * sum("end" - "start" + 1) / max("end"), 4) AS ratio FROM islands GROUP BY region""",
    "intergenic_gaps": f"""WITH {t.FEATURES}, {_ISLANDS}, following AS (SELECT *, lead("start") OVER (PARTITION BY region ORDER BY "start") AS next FROM islands)
SELECT region, "end" + 1 AS "start", next - 1 AS "end" FROM following WHERE next > "end" + 1""",
    "exon_overlap_pairs": f"""WITH {t.EXONS}, {_PAIRS}
SELECT gene_id, other_id, count(*) AS n_pairs, sum(shared)::BIGINT AS shared FROM pairs WHERE gene_id < other_id GROUP BY 1, 2""",
    "overlap_anti_join": _clear("NOT"),
    "overlap_semi_join": _clear(""),
    "repeat_coverage_of_genes": f"""WITH {t.EXONS}, {t.FEATURES.replace('features AS', 'all_features AS')}, features AS (SELECT * FROM all_features WHERE flag = 'R'), {_ISLANDS}
SELECT gene_id, length, coalesce(covered, 0)::BIGINT AS covered, round(100 * coalesce(covered, 0) / length, 4) AS percent
FROM (SELECT gene_id, sum("end" - "start" + 1)::BIGINT AS length FROM exons GROUP BY 1) LEFT JOIN (
  SELECT gene_id, sum(least(e."end", i."end") - greatest(e."start", i."start") + 1) AS covered
  FROM exons e JOIN islands i ON e.region = i.region AND e."start" <= i."end" AND e."end" >= i."start" GROUP BY 1) USING (gene_id)""",
    "interval_subtraction": f"""WITH {t.EXONS}, {t.FEATURES}, bases AS (
  SELECT gene_id, rank, unnest(range("start", "end" + 1)) AS pos, region FROM exons
), kept AS (
  SELECT gene_id, rank, pos, pos - row_number() OVER (PARTITION BY gene_id, rank ORDER BY pos) AS run FROM bases ANTI JOIN (
    SELECT DISTINCT region, unnest(range("start", "end" + 1)) AS pos FROM features WHERE flag = 'R') masked USING (region, pos)
)
SELECT gene_id, rank, count(DISTINCT run) AS pieces, count(*) AS bases, min(pos) AS first, max(pos) AS last FROM kept GROUP BY 1, 2""",
    "depth_histogram": f"""WITH {t.FEATURES}, {_DEPTH}
SELECT region, depth, sum("end" - "start" + 1)::BIGINT AS bases FROM runs WHERE depth > 0 GROUP BY 1, 2""",
    "saturated_zones": f"""WITH {t.FEATURES}, {_DEPTH}, high AS (
  SELECT *, CASE WHEN "start" = lag("end") OVER (PARTITION BY region ORDER BY "start") + 1 THEN 0 ELSE 1 END AS opens FROM runs WHERE depth >= 3
), zones AS (
  SELECT region, zone, min("start") AS "start", max("end") AS "end", sum(depth * ("end" - "start" + 1))::BIGINT AS total FROM (
    SELECT *, sum(opens) OVER (PARTITION BY region ORDER BY "start") AS zone FROM high) GROUP BY 1, 2
)
SELECT region, "start", "end", total, round(total / ("end" - "start" + 1), 4) AS mean FROM zones WHERE "end" - "start" + 1 >= 5""",
    "read_clusters_by_gap": f"""WITH {t.READS}, marked AS (
  SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY region ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3600 THEN 1 ELSE 0 END AS opens FROM reads
)
SELECT region, (island + 1)::BIGINT AS island, min("start") AS "start", max("end") AS "end", count(*) AS reads, count(DISTINCT biotype) AS biotypes FROM (
  SELECT *, sum(opens) OVER (PARTITION BY region ORDER BY "start", "end" RANGE UNBOUNDED PRECEDING) AS island FROM marked) GROUP BY 1, 2""",
    "span_clusters_by_strand": f"""WITH {t.EXONS}, {t.TRANSCRIPTS}, marked AS (
  SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY region, strand ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM transcripts
)
SELECT region, strand, (island + 1)::BIGINT AS island, count(*) AS genes, min(gene_id) AS first_gene, min("start") AS "start", max("end") AS "end" FROM (
  SELECT *, sum(opens) OVER (PARTITION BY region, strand ORDER BY "start", "end" RANGE UNBOUNDED PRECEDING) AS island FROM marked) GROUP BY 1, 2, 3""",
    "exon_overlap_clusters": _COMPONENTS + "SELECT gene_id, cluster FROM roots",
    "cluster_labels": _COMPONENTS + """, joined AS (SELECT DISTINCT gene_id, cluster, source FROM roots JOIN exons USING (gene_id)),
facts AS (SELECT cluster, count(*) AS n_genes, count(DISTINCT source) AS n_sets FROM joined GROUP BY 1)
SELECT gene_id, cluster, n_genes, n_sets, CASE WHEN n_sets = 2 THEN 'two' ELSE 'one' END AS way FROM joined JOIN facts USING (cluster)""",
    "padded_neighbours": f"""WITH {t.EXONS}, {t.TRANSCRIPTS}
SELECT a.gene_id AS gene_id, count(*) AS near, min(b.gene_id) AS first_near FROM transcripts a JOIN transcripts b
  ON a.region = b.region AND a.strand <> b.strand AND a."start" <= b."end" + 50 AND a."end" >= greatest(b."start" - 50, 1) GROUP BY 1""",
    "single_exon_in_span": f"""WITH {t.EXONS}, {t.TRANSCRIPTS}
SELECT a.gene_id AS gene_id, count(*) AS spans FROM transcripts a JOIN transcripts b ON a.region = b.region AND a.strand = b.strand
  AND a."start" <= b."end" AND a."end" >= b."start" WHERE a.n_exons = 1 GROUP BY 1 HAVING count(*) > 1""",
    "window_coverage": f"""WITH {t.FEATURES}, {_ISLANDS}, tops AS (SELECT region, max("end") AS length FROM islands GROUP BY 1), windows AS (
  SELECT region, s AS "start", least(s + 499, length) AS "end" FROM (SELECT region, length, unnest(range(1, length + 1, 500)) AS s FROM tops)
)
SELECT w.region AS region, w."start" AS "start", w."end" AS "end", coalesce(sum(least(w."end", i."end") - greatest(w."start", i."start") + 1), 0)::BIGINT AS covered
FROM windows w LEFT JOIN islands i ON w.region = i.region AND w."start" <= i."end" AND w."end" >= i."start" GROUP BY 1, 2, 3""",
}
