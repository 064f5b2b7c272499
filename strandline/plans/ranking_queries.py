"""Ranking, layering and classification over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, ranking
from ..operators.graph import checkpointed
from ..sources import driver_tables as t

STRANDED = ["region", "strand"]
DENSE, SPARSE = 64, 1024
HIT_ID = ["gene_id", "start", "end", "score"]
LAYERS = [
    ("high", ["1-URGENT"], [], False),
    ("middle", ["2-HIGH", "3-MEDIUM"], ["high"], False),
    ("noise", ["4-NOT SPECIFIED"], [], True),
    ("low", ["5-LOW"], ["high", "middle", "noise"], False),
]


def best_in_genome(spark, sf):
    rows = t.features(spark, sf).withColumn("spliced", F.col("score") > 20000)
    order = [F.desc("coverage"), F.desc("identity"), F.col("gene_id"), F.col("start"), F.col("end"), F.col("score")]
    found = ranking.best_in_genome(rows, ["hit"], min_coverage=95, min_identity=96, place=["region"], order=order, spliced="spliced")
    return found.select("hit", "gene_id", "region", "start", "end", "coverage", "identity")


def best_within_two(spark, sf):
    found = ranking.best_within(t.features(spark, sf), ["hit"], "identity", within=2, least=92)
    return found.groupBy("hit").agg(F.count(F.lit(1)).alias("kept"), F.min("identity").alias("least"), F.max("identity").alias("best"))


def capped_family(spark, sf):
    hits = t.features(spark, sf).withColumn("evalue", F.round(100 - F.col("identity"), 4)).withColumn("family", F.col("hit") % 50)
    found = ranking.capped_by_value(hits, ["family"], "evalue", 20, 4.0)
    return found.select("family", "gene_id", "start", "end", "evalue", F.col("rank_in_group").alias("rank"))


def top_hits_per_region(spark, sf):
    found = ranking.top_rows(t.features(spark, sf), ["region"], [F.desc("score"), F.col("gene_id"), F.col("start"), F.col("end")], 10)
    return found.select("region", "gene_id", "start", "end", "score", F.col("rank_in_group").alias("rank"))


def redundant_chains(spark, sf):
    from ..operators import models

    genes = t.transcripts(spark, sf)
    shape = F.transform("exons", lambda e: F.struct((e["start"] - F.col("start")).alias("start"), (e["end"] - F.col("start")).alias("end")))
    keyed = genes.withColumn("chain", models.chain_key(shape)).withColumn("n", F.size("exons"))
    kept = ranking.deduplicated(keyed, ["strand", "chain"], [F.col("biotype"), F.col("gene_id")])
    return kept.select("gene_id", "strand", "chain", "biotype", F.col("n").cast("long").alias("n_exons"))


def best_of_two_sources(spark, sf):
    hits = t.features(spark, sf)
    best = lambda flag: hits.filter(F.col("flag") == flag).groupBy("hit").agg(F.max("coverage").alias("coverage"), F.max("identity").alias("identity"))
    found = ranking.best_of_two(best("A"), best("R"), "hit", ("a", "r"))
    return found.withColumn("total", F.round("total", 4))


def domain_selection(spark, sf):
    hits = t.features(spark, sf).filter("flag = 'R'").withColumn("row_id", F.xxhash64("gene_id", "start", "end", "score", "hit"))
    kept = ranking.domains(hits.withColumn("family", F.col("hit") % 20), STRANDED, "family", "score", "row_id", DENSE)
    return kept.groupBy(*STRANDED).agg(F.count(F.lit(1)).alias("kept"), F.round(F.sum("score"), 2).alias("total"), F.min("start").alias("first"))


def depth_filter(spark, sf):
    hits = t.features(spark, sf).filter("flag <> 'N'")
    kept = ranking.depth_capped(hits, STRANDED, "hit", "score", cap=2, min_identity=95, scope=DENSE)
    return kept.select("region", "strand", "hit")


def layer_selection(spark, sf):
    exons = t.exons(spark, sf)
    genes = t.transcripts(spark, sf).drop("exons")
    return ranking.layered(genes, exons, LAYERS, STRANDED, SPARSE).select("gene_id", "biotype", "layer")


_HITS = 'a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start"'
_LAYERS = f"""
WITH {t.EXONS}, touch AS (
  SELECT DISTINCT a.gene_id AS gene_id, a.biotype AS biotype, b.gene_id AS other, b.biotype AS other_biotype FROM exons a JOIN exons b ON {_HITS} AND a.gene_id <> b.gene_id
), genes AS (SELECT DISTINCT gene_id, biotype FROM exons),
high AS (SELECT gene_id, biotype FROM genes WHERE biotype = '1-URGENT'),
middle AS (SELECT gene_id, biotype FROM genes WHERE biotype IN ('2-HIGH', '3-MEDIUM')
  AND gene_id NOT IN (SELECT gene_id FROM touch WHERE other IN (SELECT gene_id FROM high))),
noise AS (SELECT gene_id, biotype FROM genes WHERE biotype = '4-NOT SPECIFIED'),
low AS (SELECT gene_id, biotype FROM genes WHERE biotype = '5-LOW'
  AND gene_id NOT IN (SELECT gene_id FROM touch WHERE other IN (SELECT gene_id FROM high UNION ALL SELECT gene_id FROM middle UNION ALL SELECT gene_id FROM noise)))
SELECT *, 'high' AS layer FROM high UNION ALL SELECT *, 'middle' FROM middle UNION ALL SELECT *, 'low' FROM low
"""


def support_tiers(spark, sf):
    found = classify.tiers(t.features(spark, sf), classify.STANDARD_TIERS)
    return found.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("coverage"), 4).alias("mean_coverage"))


def intron_support(spark, sf):
    genes = t.transcripts(spark, sf)
    reads = t.features(spark, sf).groupBy("gene_id").agg(F.count_if(F.col("flag") == "N").alias("good"), F.count(F.lit(1)).alias("total"))
    found = classify.intron_support(genes.join(reads, "gene_id"), "good", "total")
    return found.groupBy("support").agg(F.count(F.lit(1)).alias("n"), F.sum("difference").alias("difference"))


def _repeats(spark, sf):
    """Features of one flag as repeats, on the scale of the exons."""
    return t.features(spark, sf).filter("flag = 'R'").select("region", (F.col("start") * 20).alias("start"), (F.col("start") * 20 + F.col("end") - F.col("start")).alias("end"))


def model_evidence(spark, sf):
    return classify.model_evidence(t.exons(spark, sf), _repeats(spark, sf), ["region"], 20, SPARSE)


def pseudogene_calls(spark, sf):
    exons = checkpointed(t.exons(spark, sf).select("gene_id", "region", "start", "end", "biotype", "hit"))
    evidence = classify.model_evidence(exons, _repeats(spark, sf), ["region"], 20, SPARSE)
    features = exons.select("gene_id", "hit", "region", (F.col("start") - F.col("hit") % 50).alias("start"), (F.col("end") + F.col("hit") % 60).alias("end"))
    dodgy = classify.covered_single_introns(exons, features, ["region"], 20, 30.0, width=SPARSE)
    models = exons.select("gene_id", "biotype").distinct()
    return classify.pseudogenes(models, evidence, dodgy, ["1-URGENT"], ["2-"], 30.0, 40.0, 120, 1, 1, 1).select("gene_id", "biotype", "call")


_TIERS = "CASE " + " ".join(f"WHEN coverage >= {c} AND identity >= {i} THEN 'tier_{n}'" for n, (c, i) in enumerate(classify.STANDARD_TIERS, 1)) + " END"


def kill_list(spark, sf):
    from ..operators import filters

    listed = t.table(spark, sf, "part").filter("p_size > 45").select(F.col("p_partkey").alias("hit"))
    kept = filters.without_listed(t.features(spark, sf), listed, "hit")
    return kept.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hit").alias("hits"))


def named_thresholds(spark, sf):
    from ..operators import filters

    kept = filters.thresholds(t.features(spark, sf), {"identity": "95", "coverage": "lessthan 98", "score": "20000"})
    return kept.select("gene_id", "hit", "start", "end", "identity", "coverage", "score")


def family_cutoffs(spark, sf):
    from ..operators import filters

    cutoffs = t.table(spark, sf, "part").select(F.col("p_partkey").alias("hit"), (20 * F.col("p_retailprice")).alias("cutoff")).filter("hit % 2 = 0")
    kept = filters.over_cutoff(t.features(spark, sf), cutoffs, "hit", "score", 25000.0)
    return kept.groupBy("hit").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best"))


QUERIES = {
    "best_in_genome": best_in_genome,
    "best_within_two": best_within_two,
    "capped_family": capped_family,
    "top_hits_per_region": top_hits_per_region,
    "redundant_chains": redundant_chains,
    "best_of_two_sources": best_of_two_sources,
    "domain_selection": domain_selection,
    "depth_filter": depth_filter,
    "layer_selection": layer_selection,
    "support_tiers": support_tiers,
    "intron_support": intron_support,
    "model_evidence": model_evidence,
    "pseudogene_calls": pseudogene_calls,
    "kill_list": kill_list,
    "named_thresholds": named_thresholds,
    "family_cutoffs": family_cutoffs,
}

_EVIDENCE = f"""WITH {t.EXONS}, {t.FEATURES}, gaps AS (
  SELECT * FROM (SELECT gene_id, region, "end" + 1 AS s, lead("start") OVER (PARTITION BY gene_id ORDER BY "start", "end") - 1 AS e FROM exons) WHERE e >= s
), masked AS (SELECT DISTINCT region, unnest(range(20 * "start", 20 * "start" + "end" - "start" + 1)) AS pos FROM features WHERE flag = 'R'
), inside AS (
  SELECT gene_id, 'exon' AS kind, region, unnest(range("start", "end" + 1)) AS pos FROM exons UNION ALL SELECT gene_id, 'intron', region, unnest(range(s, e + 1)) FROM gaps
), shares AS (
  SELECT gene_id, count(*) FILTER (kind = 'exon' AND m.pos IS NOT NULL) AS ec, count(*) FILTER (kind = 'exon') AS en, count(*) FILTER (kind = 'intron' AND m.pos IS NOT NULL) AS ic, count(*) FILTER (kind = 'intron') AS n
  FROM inside i LEFT JOIN masked m USING (region, pos) GROUP BY 1
), counts AS (SELECT gene_id, count(*) AS introns, count(*) FILTER (e - s + 1 > 20) AS "real" FROM gaps GROUP BY 1
), sizes AS (SELECT gene_id, count(*) AS n_exons FROM exons GROUP BY 1
), evidence AS (
  SELECT gene_id, n_exons, coalesce(introns, 0) AS introns, coalesce("real", 0) AS "real", coalesce(introns - "real", 0) AS frameshift, n AS intron_length,
    round(100.0 * ec / en, 4) AS covered_exons, CASE WHEN n > 0 THEN round(100.0 * ic / n, 4) ELSE 0 END AS covered_introns FROM sizes JOIN shares USING (gene_id) LEFT JOIN counts USING (gene_id)
)"""

ORACLE_SQL = {
    "best_in_genome": f"""WITH {t.FEATURES}
SELECT hit, gene_id, region, "start", "end", coverage, identity FROM (SELECT *, max(coverage) OVER (PARTITION BY hit) AS top, score > 20000 AS spliced,
  row_number() OVER w AS n, first_value(region) OVER w AS b_region, first_value("start") OVER w AS b_start, first_value("end") OVER w AS b_end, first_value(score > 20000) OVER w AS b_spliced
  FROM features WINDOW w AS (PARTITION BY hit ORDER BY coverage DESC, identity DESC, gene_id, "start", "end", score))
WHERE coverage = top AND ((coverage >= 95 AND identity >= 96) OR (coverage >= 1.05 * 95 AND identity >= 0.97 * 96))
  AND NOT (region = b_region AND "start" < b_start AND "end" > b_end) AND (n = 1 OR spliced OR NOT b_spliced)""",
    "best_within_two": f"""WITH {t.FEATURES}, best AS (SELECT *, max(identity) OVER (PARTITION BY hit) AS top FROM features)
SELECT hit, count(*) AS kept, min(identity) AS least, max(identity) AS best FROM best WHERE top >= 92 AND identity >= top - 2 AND identity >= 92 GROUP BY hit""",
    "capped_family": f"""WITH {t.FEATURES}, ranked AS (
  SELECT hit % 50 AS family, gene_id, "start", "end", round(100 - identity, 4) AS evalue,
    rank() OVER (PARTITION BY hit % 50 ORDER BY round(100 - identity, 4))::INTEGER AS rank FROM features)
SELECT * FROM ranked WHERE rank <= 20 AND evalue <= 4.0""",
    "top_hits_per_region": f"""WITH {t.FEATURES}, ranked AS (
  SELECT region, gene_id, "start", "end", score, row_number() OVER (PARTITION BY region ORDER BY score DESC, gene_id, "start", "end")::INTEGER AS rank FROM features)
SELECT * FROM ranked WHERE rank <= 10""",
    "redundant_chains": f"""WITH {t.EXONS}, models AS (
  SELECT gene_id, strand, biotype, string_agg(("start" - low)::VARCHAR || ':' || ("end" - low)::VARCHAR, ':' ORDER BY rank) AS chain, count(*) AS n_exons
  FROM (SELECT *, min("start") OVER (PARTITION BY gene_id) AS low FROM exons) GROUP BY 1, 2, 3)
SELECT gene_id, strand, chain, biotype, n_exons FROM models QUALIFY row_number() OVER (PARTITION BY strand, chain ORDER BY biotype, gene_id) = 1""",
    "best_of_two_sources": f"""WITH {t.FEATURES}, a AS (SELECT hit, max(coverage) + max(identity) AS s FROM features WHERE flag = 'A' GROUP BY 1),
r AS (SELECT hit, max(coverage) + max(identity) AS s FROM features WHERE flag = 'R' GROUP BY 1)
SELECT hit, CASE WHEN r.s IS NULL OR a.s > r.s THEN 'a' ELSE 'r' END AS winner,
  CASE WHEN a.s IS NOT NULL AND r.s IS NOT NULL THEN CASE WHEN a.s > r.s THEN 'r' ELSE 'a' END END AS loser,
  round(CASE WHEN r.s IS NULL OR a.s > r.s THEN a.s ELSE r.s END, 4) AS total FROM a FULL JOIN r USING (hit)""",
    "layer_selection": _LAYERS,
    "support_tiers": f"""WITH {t.FEATURES}
SELECT {_TIERS} AS tier, count(*) AS n, round(avg(coverage), 4) AS mean_coverage FROM features GROUP BY 1""",
    "intron_support": f"""WITH {t.FEATURES}, counts AS (
  SELECT gene_id, count(*) FILTER (flag = 'N') AS good, count(*) AS total FROM features GROUP BY 1), scored AS (
  SELECT good - (total - good) AS d FROM counts)
SELECT CASE WHEN d >= 8 THEN 'top' WHEN d >= 6 THEN 'high' WHEN d >= 4 THEN 'medium' WHEN d >= 2 THEN 'low' WHEN d >= 1 THEN 'weak' ELSE 'none' END AS support,
  count(*) AS n, sum(d)::BIGINT AS difference FROM scored GROUP BY 1""",
    "kill_list": f"""WITH {t.FEATURES}
SELECT flag, count(*) AS n, count(DISTINCT hit) AS hits FROM features WHERE hit NOT IN (SELECT p_partkey FROM part WHERE p_size > 45) GROUP BY 1""",
    "named_thresholds": f"""WITH {t.FEATURES}
SELECT gene_id, hit, "start", "end", identity, coverage, score FROM features WHERE identity > 95 AND coverage < 98 AND score > 20000""",
    "family_cutoffs": f"""WITH {t.FEATURES}
SELECT hit, count(*) AS n, max(score) AS best FROM features LEFT JOIN part ON hit = p_partkey AND p_partkey % 2 = 0
WHERE score > coalesce(20 * p_retailprice, 25000) GROUP BY 1""",
    "model_evidence": f"""{_EVIDENCE} SELECT * FROM evidence""",
    "pseudogene_calls": f"""{_EVIDENCE}, spans AS (SELECT gene_id, hit, "start" - hit % 50 AS s, "end" + hit % 60 AS e FROM exons
), first_gap AS (SELECT gene_id, s, e FROM gaps WHERE e - s + 1 > 20 QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY s, e) = 1
), under AS (SELECT DISTINCT g.gene_id AS gene_id, hit, any_value(e - s + 1) OVER (PARTITION BY g.gene_id) AS n, pos FROM (
  SELECT g.gene_id, x.hit, g.s, g.e, unnest(range(greatest(g.s, x.s), least(g.e, x.e) + 1)) AS pos FROM first_gap g JOIN spans x ON x.gene_id = g.gene_id AND x.s <= g.e AND x.e >= g.s) g
), dodgy AS (SELECT gene_id FROM (SELECT gene_id, hit, any_value(n) AS n, count(*) AS k FROM under GROUP BY 1, 2) WHERE 100 * k > 30 * n GROUP BY 1 HAVING count(*) > 1
), joined AS (SELECT DISTINCT gene_id, biotype, evidence.* EXCLUDE (gene_id), gene_id IN (SELECT gene_id FROM dodgy) AS odd, covered_exons >= 30 AS under, covered_introns >= 40 AS filled FROM exons JOIN evidence USING (gene_id))
SELECT gene_id, biotype, CASE WHEN n_exons = 1 AND NOT under AND biotype <> '1-URGENT' THEN 'single_exon' WHEN biotype LIKE '2-%' THEN 'real'
  WHEN intron_length < 120 AND frameshift >= 1 AND "real" >= 1 AND filled THEN 'pseudo' WHEN introns > 0 AND frameshift = introns THEN 'pseudo' WHEN frameshift > 1 THEN 'pseudo' WHEN under THEN 'repeat'
  WHEN frameshift >= 1 OR (filled AND biotype <> '1-URGENT') THEN 'indeterminate' WHEN "real" = 1 AND odd THEN 'pseudo' ELSE 'real' END AS call FROM joined""",
}
