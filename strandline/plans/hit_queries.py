"""Rules on sets of hits over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hits
from ..sources import driver_tables as t

DENSE = 64


def cluster_best_names(spark, sf):
    rows = t.features(spark, sf).filter("flag = 'A'")
    found = hits.best_names_per_cluster(rows, ["region"], "hit", "score", 3, DENSE)
    return found.select("region", "island", "hit", "total", "mean", F.col("place").cast("int").alias("place"))


def unbeaten_hits(spark, sf):
    rows = t.reads(spark, sf).filter("biotype = 'purchase'")
    return hits.beaten_by_overlap(rows, ["region"], "value", "read_id", 86400).select("read_id", "region", "start", "end", "value")


def brand_votes(spark, sf):
    parts = t.table(spark, sf, "part").select("p_brand", "p_partkey", (F.col("p_size") > 25).alias("large"), (F.col("p_retailprice") > 1200).alias("dear"), F.contains("p_type", F.lit("STEEL")).alias("steel"))
    return hits.weighted_vote(parts, "p_brand", "p_partkey", {"large": 4, "dear": 2, "steel": 1})


def part_coverage(spark, sf):
    lines = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").cast("long").alias("hit_start"), (F.col("l_linenumber") + F.col("l_quantity").cast("int")).cast("long").alias("hit_end"))
    lengths = t.table(spark, sf, "part").select(F.col("p_partkey").alias("part"), (F.col("p_size") + 60).cast("long").alias("length"))
    return hits.evidence_coverage(lines, ["supplier"], lengths, "part")


def collapsed_parts(spark, sf):
    parts = t.table(spark, sf, "part").select("p_brand", "p_type", "p_partkey", "p_size")
    found = hits.collapsed_probes(parts, ["p_brand", "p_type"], ["p_partkey", "p_size"])
    return found.select("p_brand", "p_type", F.array_join("members", ",").alias("members"), "n")


QUERIES = {f.__name__: f for f in (cluster_best_names, unbeaten_hits, brand_votes, part_coverage, collapsed_parts)}

ORACLE_SQL = {
    "cluster_best_names": f"""WITH {t.FEATURES}, chosen AS (SELECT * FROM features WHERE flag = 'A'), marked AS (
  SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY region ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM chosen
), islands AS (SELECT *, (sum(opens) OVER (PARTITION BY region ORDER BY "start", "end" RANGE UNBOUNDED PRECEDING) + 1)::BIGINT AS island FROM marked), totals AS (
  SELECT region, island, hit, round(sum(score), 4) AS total, round(avg(identity), 4) AS mean FROM islands GROUP BY 1, 2, 3)
SELECT *, row_number() OVER (PARTITION BY region, island ORDER BY total DESC, mean DESC, hit)::INTEGER AS place FROM totals QUALIFY place <= 3""",
    "unbeaten_hits": f"""WITH {t.READS}, p AS (SELECT * FROM reads WHERE biotype = 'purchase')
SELECT read_id, region, "start", "end", value FROM p a WHERE NOT EXISTS (
  SELECT 1 FROM p b WHERE b.region = a.region AND b.read_id <> a.read_id AND b."start" <= a."end" AND b."end" >= a."start" AND (b.value > a.value OR (b.value = a.value AND b.read_id < a.read_id)))""",
    "brand_votes": """WITH v AS (SELECT p_brand, p_partkey, CASE WHEN p_size > 25 THEN 4 ELSE 0 END + CASE WHEN p_retailprice > 1200 THEN 2 ELSE 0 END + CASE WHEN contains(p_type, 'STEEL') THEN 1 ELSE 0 END AS votes FROM part)
SELECT p_brand, p_partkey, votes FROM v QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY votes DESC, p_partkey) = 1""",
    "part_coverage": """SELECT l_suppkey AS supplier, l_partkey AS part, floor(100 * (max(l_linenumber + l_quantity::INTEGER) - min(l_linenumber) + 1) / any_value(p_size + 60))::BIGINT AS percent
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "collapsed_parts": """SELECT p_brand, p_type, string_agg(DISTINCT p_partkey || ':' || p_size, ',' ORDER BY p_partkey || ':' || p_size) AS members, count(DISTINCT p_partkey || ':' || p_size) AS n FROM part GROUP BY 1, 2""",
}
