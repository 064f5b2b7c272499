"""Merging sets of models and adding untranslated exons, over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging
from ..sources import driver_tables as t

STRANDED = ["region", "strand"]


def _models(spark, sf):
    """Models on the grid: two of three are coding, from the base 10 after the grid start of the first exon to 10 before that of
    the last one's end; manual ones are those of closed orders."""
    exons = t.snapped(spark, sf)
    own = F.array_sort(F.collect_list(F.struct("rank", "start", "end")))
    locus = F.floor(F.min("start") / 1000)
    grouped = exons.groupBy("gene_id", *STRANDED, "source").agg(own.alias("exons"), locus.alias("locus"), F.count(F.lit(1)).alias("n"))
    low = 1000 * F.col("locus") + 131
    high = 1000 * F.col("locus") + 100 * F.col("n") + 50
    coding = F.col("gene_id") % 3 != 0
    return grouped.withColumns({"cds_start": F.when(coding, low).cast("long"), "cds_end": F.when(coding, high).cast("long"), "manual": F.col("source") == "F", "complete": F.col("gene_id") % 7 != 0, "listed": F.col("gene_id") % 5 == 0, "small": F.col("gene_id") % 2 == 0})


def matched_models(spark, sf):
    return merging.matched_models(_models(spark, sf), [*STRANDED, "locus"])


def merged_models(spark, sf):
    models = _models(spark, sf)
    evidence = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("gene_id"), F.col("l_partkey").alias("hit"))
    return merging.merged_set(models, merging.matched_models(models, [*STRANDED, "locus"]), evidence)


def utr_models(spark, sf):
    models = _models(spark, sf)
    donors = models.filter("NOT manual").withColumn("priority", F.when(F.col("source") == "O", 1).otherwise(2))
    found = merging.with_utr(models.filter("manual AND cds_start IS NOT NULL"), donors, STRANDED)
    return found.select("gene_id", "low_donor", "high_donor", F.size("exons").cast("long").alias("n_exons"), F.get("exons", F.lit(0))["start"].alias("start"), F.try_element_at("exons", F.lit(-1))["end"].alias("end"), "low_utr", "high_utr", "cds_in_cdna")


QUERIES = {"matched_models": matched_models, "merged_models": merged_models, "utr_models": utr_models}

_MODELS = f"""
WITH {t.SNAPPED.strip()}, shaped AS (
  SELECT gene_id, region, strand, source, min("start") // 1000 AS locus, count(*) AS n, min("start") AS "start", max("end") AS "end",
    sum("end" - "start" + 1)::BIGINT AS length, list("start" ORDER BY rank) AS starts, list("end" ORDER BY rank) AS ends
  FROM snapped GROUP BY ALL
), models AS (
  SELECT *, CASE WHEN gene_id % 3 <> 0 THEN 1000 * locus + 131 END AS cds_start, CASE WHEN gene_id % 3 <> 0 THEN 1000 * locus + 100 * n + 50 END AS cds_end,
    source = 'F' AS manual, gene_id % 7 <> 0 AS complete, gene_id % 5 = 0 AS listed, gene_id % 2 = 0 AS small,
    ends[:-2]::VARCHAR || starts[2:]::VARCHAR AS chain FROM shaped
)"""

_MATCHES = f"""{_MODELS}, typed AS (
  SELECT *, cds_start IS NOT NULL AS coding, complete OR listed AS fit, "start" = cds_start AND "end" = cds_end AS bare FROM models
), pairs AS (
  SELECT e.gene_id AS auto_id, h.gene_id AS manual_id,
    CASE
      WHEN e.coding AND NOT e.fit THEN 'incomplete'
      WHEN NOT e.coding AND NOT h.coding THEN
        CASE WHEN e.n = 1 AND e.small AND e.length = h.length THEN 'kept'
          WHEN e.n = 1 AND (e."start" <> h."start" OR e."end" <> h."end") THEN NULL WHEN e.chain = h.chain THEN 'replaced' END
      WHEN NOT e.coding THEN
        CASE WHEN e.n = 1 AND e."start" = h.cds_start AND e."end" = h.cds_end THEN 'replaced' WHEN e.n > 1 AND e.chain = h.chain THEN 'replaced' END
      WHEN NOT h.coding THEN CASE WHEN e.listed THEN NULL WHEN e.n = 1 OR e.chain = h.chain THEN 'replaced' END
      WHEN e.cds_start <> h.cds_start OR e.cds_end <> h.cds_end THEN NULL
      WHEN e.n = 1 THEN
        CASE WHEN e."start" = h."start" AND e."end" = h."end" THEN 'replaced' WHEN e.bare THEN 'replaced' ELSE 'kept' END
      WHEN e.ends[2:-2] = h.ends[2:-2] AND e.starts[2:-2] = h.starts[2:-2] THEN CASE WHEN e.chain = h.chain THEN 'replaced' ELSE 'variant' END
    END AS relation
  FROM typed e JOIN typed h USING (region, strand, locus, n) WHERE NOT e.manual AND h.manual
), matches AS (SELECT auto_id, relation, min(manual_id) AS manual_id FROM pairs WHERE relation IS NOT NULL GROUP BY 1, 2)"""

_UTR = f"""{_MODELS}, cut AS (
  SELECT gene_id, region, strand, greatest("start", 1000 * locus + 131) AS s, least("end", 1000 * locus + 100 * n + 50) AS e
  FROM (SELECT snapped.*, locus FROM snapped JOIN models USING (gene_id)) WHERE source = 'F' AND gene_id % 3 <> 0
), acceptors AS (
  SELECT gene_id, region, strand, s, e, count(*) OVER w AS n, row_number() OVER (w ORDER BY s) AS k, lead(s) OVER (w ORDER BY s) AS after, min(s) OVER w AS low, max(e) OVER w AS high,
    first_value(e) OVER (w ORDER BY s) AS first_end, last_value(s) OVER (w ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_start
  FROM cut WINDOW w AS (PARTITION BY gene_id)
), every_donor AS (
  SELECT gene_id, region, strand, CASE source WHEN 'O' THEN 1 ELSE 2 END AS priority, "start" AS s, "end" AS e, n, list("start") OVER w AS starts, list("end") OVER w AS ends,
    lead("start") OVER (PARTITION BY gene_id ORDER BY "start") AS after FROM snapped WHERE source <> 'F'
  WINDOW w AS (PARTITION BY gene_id ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), donors AS (SELECT * FROM every_donor QUALIFY gene_id = min(gene_id) OVER (PARTITION BY region, strand, priority, starts, ends)
), met AS (
  SELECT a.gene_id AS acceptor, d.gene_id AS donor, priority, count(*) AS shared, bool_or(a.k = 1) AS met_low, bool_or(a.k = a.n - 1) AS met_high
  FROM acceptors a JOIN donors d ON a.region = d.region AND a.strand = d.strand AND a.e = d.e AND a.after = d.after GROUP BY 1, 2, 3
), seen AS (
  SELECT * FROM (SELECT *, max(CASE WHEN NOT met_low AND NOT met_high THEN shared END) OVER (PARTITION BY acceptor, priority) AS blocked FROM met)
  WHERE (met_low OR met_high) AND (blocked IS NULL OR shared >= blocked)
), tops AS (SELECT DISTINCT gene_id, low, high, first_end, last_start FROM acceptors
), parts AS (
  SELECT acceptor, donor, seen.priority AS priority, shared, met_low, met_high, low, high, first_end, last_start,
    count(*) FILTER (WHERE e <= first_end) AS low_exons, count(*) FILTER (WHERE s >= last_start) AS high_exons, min(s) AS d_low, max(e) AS d_high,
    max(s) FILTER (WHERE e <= first_end) AS joint_low, min(e) FILTER (WHERE s >= last_start) AS joint_high,
    sum(e - s + 1) FILTER (WHERE e <= first_end) - (first_end - low + 1) AS low_bases, sum(e - s + 1) FILTER (WHERE s >= last_start) - (high - last_start + 1) AS high_bases
  FROM seen JOIN tops ON tops.gene_id = acceptor JOIN donors ON donors.gene_id = donor
  GROUP BY acceptor, donor, seen.priority, shared, met_low, met_high, low, high, first_end, last_start
), offers AS (
  SELECT *, coalesce(met_low AND joint_low < low AND (low_exons > 1 OR low - d_low <= 10000), false) AS at_low,
    coalesce(met_high AND joint_high > high AND (high_exons > 1 OR d_high - high <= 10000), false) AS at_high FROM parts
), layers AS (
  SELECT *, min(CASE WHEN at_low AND at_high THEN priority END) OVER (PARTITION BY acceptor) AS l_both,
    min(CASE WHEN at_low <> at_high THEN priority END) OVER (PARTITION BY acceptor) AS l_single FROM offers
), boths AS (
  SELECT * FROM layers WHERE at_low AND at_high AND priority = l_both AND (l_single IS NULL OR l_both <= l_single)
  QUALIFY row_number() OVER (PARTITION BY acceptor ORDER BY shared DESC, low_exons + high_exons DESC, low_bases + high_bases DESC, donor) = 1
), taken AS (
  SELECT * FROM boths b WHERE NOT (
    EXISTS (SELECT 1 FROM layers x WHERE x.acceptor = b.acceptor AND x.priority = b.priority AND x.at_low AND NOT x.at_high AND x.shared > b.shared)
    AND EXISTS (SELECT 1 FROM layers x WHERE x.acceptor = b.acceptor AND x.priority = b.priority AND x.at_high AND NOT x.at_low AND x.shared > b.shared))
), sides AS (SELECT * FROM layers WHERE (at_low <> at_high) OR (at_low AND at_high AND priority > l_single)
), lows AS (
  SELECT * FROM (SELECT * FROM sides WHERE at_low QUALIFY priority = min(priority) OVER (PARTITION BY acceptor))
  QUALIFY row_number() OVER (PARTITION BY acceptor ORDER BY shared DESC, low_exons DESC, low_bases DESC, donor) = 1
), highs AS (
  SELECT * FROM (SELECT * FROM sides WHERE at_high QUALIFY priority = min(priority) OVER (PARTITION BY acceptor))
  QUALIFY row_number() OVER (PARTITION BY acceptor ORDER BY shared DESC, high_exons DESC, high_bases DESC, donor) = 1
), singles AS (
  SELECT a.gene_id AS acceptor, d.gene_id AS donor, d.s AS s, d.e AS e FROM acceptors a JOIN donors d ON a.region = d.region AND a.strand = d.strand
    AND d.s <= a.s AND d.e >= a.e AND (d.s < a.s OR d.e > a.e) WHERE a.n = 1 AND d.n = 1
  QUALIFY row_number() OVER (PARTITION BY a.gene_id ORDER BY priority, d.e - d.s DESC, d.gene_id) = 1
), genes AS (SELECT DISTINCT gene_id, strand, n, low, high FROM acceptors
), ended AS (
  SELECT g.gene_id AS gene_id, strand, g.n AS n, g.low AS low, g.high AS high, coalesce(t.donor, l.donor, x.donor) AS low_donor, coalesce(t.donor, h.donor, x.donor) AS high_donor,
    coalesce(t.low_exons, l.low_exons, 1) AS low_exons, coalesce(t.high_exons, h.high_exons, 1) AS high_exons, coalesce(t.d_low, l.d_low, x.s, g.low) AS "start", coalesce(t.d_high, h.d_high, x.e, g.high) AS "end",
    coalesce(t.low_bases, l.low_bases, g.low - x.s, 0)::BIGINT AS low_utr, coalesce(t.high_bases, h.high_bases, x.e - g.high, 0)::BIGINT AS high_utr
  FROM genes g LEFT JOIN taken t ON t.acceptor = g.gene_id LEFT JOIN lows l ON l.acceptor = g.gene_id AND t.acceptor IS NULL
  LEFT JOIN highs h ON h.acceptor = g.gene_id AND t.acceptor IS NULL LEFT JOIN singles x ON x.acceptor = g.gene_id
)
SELECT gene_id, low_donor, high_donor, CASE WHEN n = 1 THEN 1 ELSE n - 2 + low_exons + high_exons END::BIGINT AS n_exons, "start", "end", low_utr, high_utr,
  CASE WHEN strand = 1 THEN low_utr ELSE high_utr END + 1 AS cds_in_cdna FROM ended"""

ORACLE_SQL = {
    "matched_models": f"{_MATCHES} SELECT auto_id, relation, manual_id FROM matches",
    "merged_models": f"""{_MATCHES}, gone AS (SELECT DISTINCT auto_id AS id FROM matches WHERE relation IN ('replaced', 'incomplete')),
turned AS (SELECT manual_id AS id, min(auto_id) AS heir FROM matches WHERE relation = 'kept' AND auto_id NOT IN (SELECT id FROM gone) GROUP BY 1),
moved AS (SELECT m.auto_id AS id, coalesce(t.heir, m.manual_id) AS heir FROM (SELECT auto_id, min(manual_id) AS manual_id FROM matches WHERE relation = 'replaced' GROUP BY 1) m LEFT JOIN turned t ON t.id = m.manual_id),
links AS (SELECT * FROM moved UNION ALL SELECT * FROM turned),
pieces AS (SELECT coalesce(heir, l_orderkey) AS id, count(DISTINCT l_partkey) AS evidence FROM lineitem LEFT JOIN links ON links.id = l_orderkey GROUP BY 1)
SELECT gene_id, CASE WHEN gene_id IN (SELECT heir FROM links) THEN 'merged' WHEN manual THEN 'manual' ELSE 'automatic' END AS source, coalesce(evidence, 0)::BIGINT AS evidence
FROM models LEFT JOIN pieces ON pieces.id = gene_id WHERE gene_id NOT IN (SELECT id FROM gone) AND gene_id NOT IN (SELECT id FROM turned)""",
    "utr_models": _UTR,
}
