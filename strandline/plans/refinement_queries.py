"""Rules on single models and alignments over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as q
from ..operators import clusters, models, refinement
from ..sources import driver_tables as t
from .building_queries import _ROOTS
from .model_queries import _peptide

STRANDED = ["region", "strand"]
DENSE, SPARSE = 64, 1024


def flagged_models(spark, sf):
    genes = t.transcripts(spark, sf)
    gaps = genes.select("gene_id", F.explode(models.introns(F.col("exons"))).alias("i")).select("gene_id", (F.col("i.end") - F.col("i.start") + 1).alias("length"))
    introns = gaps.withColumn("canonical", F.col("length") % 7 != 0)
    codon = lambda column, names: F.element_at(F.array(*map(F.lit, names)), (F.pmod(column, F.lit(len(names))) + 1).cast("int"))
    rows = genes.withColumns({"first_codon": codon(F.col("start"), ["ATG", "CTG"]), "last_codon": codon(F.col("end"), ["TAA", "TAG", "TGA", "GCC"])})
    return refinement.flagged(rows, introns, ["1-URGENT"], 14)


def accepted_reads(spark, sf):
    parts = t.exons(spark, sf).withColumn("mismatches", F.col("hit") % 5)
    return refinement.accepted_alignments(parts, "gene_id", 91, 93, 8.0)


def internal_stops(spark, sf):
    peptides = t.sequences(spark, sf).select("seq_id", q.translated(F.col("seq")).alias("peptide"))
    return refinement.internal_stops(peptides, 2)


def tailless_sequences(spark, sf):
    kept = refinement.without_tails(t.sequences(spark, sf), 20)
    return kept.select("seq_id", F.length("seq").cast("long").alias("length"), "clipped")


def model_keys(spark, sf):
    return refinement.model_keys(t.exons(spark, sf), STRANDED)


def supported_exons(spark, sf):
    evidence = t.features(spark, sf).filter("flag = 'A'").select(*STRANDED, F.col("start") * 2, F.col("end") * 2).toDF(*STRANDED, "start", "end")
    return refinement.exon_support(t.exons(spark, sf), evidence, STRANDED, SPARSE)


def merged_protein_hits(spark, sf):
    # models on the reverse strand run down their protein
    place = F.when(F.col("strand") == 1, F.col("rank")).otherwise(8 - F.col("rank"))
    lines = t.exons(spark, sf).withColumns({"protein": F.col("hit") % 40, "hit_start": (place * 20 - 19).cast("long")})
    hits = lines.withColumn("hit_end", F.col("hit_start") + F.col("end") - F.col("start")).select(*STRANDED, "protein", "start", "end", "hit_start", "hit_end")
    lengths = t.table(spark, sf, "part").groupBy((F.col("p_partkey") % 40).alias("protein")).agg((F.max("p_size") + 150).cast("long").alias("length"))
    return refinement.merged_hits(hits, [*STRANDED, "protein"], 400, lengths, "protein", "strand")


def processed_clusters(spark, sf):
    exons = t.exons(spark, sf)
    support = exons.groupBy("gene_id").agg(F.max("coverage").alias("coverage"), F.max("identity").alias("identity"), F.sum(F.col("end") - F.col("start") + 1).alias("length"))
    gaps = t.transcripts(spark, sf).select("gene_id", *STRANDED, F.explode(models.introns(F.col("exons"))).alias("i"))
    pairs = gaps.select("gene_id", F.concat_ws(":", "region", "strand", "i.start", "i.end").alias("pair"))
    return refinement.processed_clusters(support, pairs, clusters.exon_clusters(exons, STRANDED, scan_bin=SPARSE), 1.2)


def capped_hits(spark, sf):
    hits = t.features(spark, sf).select(*STRANDED, "start", "end", "hit", "score", F.round(100 - F.col("identity"), 4).alias("p_value"))
    kept = refinement.capped_hits(hits, ["region"], "hit", 20000, 6.0, 2, DENSE)
    return kept.groupBy("region").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("hit").alias("names"), F.round(F.sum("score"), 2).alias("score"))


def pruned_hits(spark, sf):
    hits = t.features(spark, sf).withColumn("row_id", F.xxhash64("gene_id", "start", "end", "score", "hit"))
    kept = refinement.pruned_depth(hits, STRANDED, "row_id", 5, DENSE)
    return kept.groupBy(*STRANDED).agg(F.count(F.lit(1)).alias("hits"), F.round(F.sum("score"), 2).alias("score"))


def identity_summary(spark, sf):
    return refinement.identity_summary(t.features(spark, sf), ["flag"], [98, 95, 92])


def evidence_sets(spark, sf):
    sets = t.table(spark, sf, "orders").select(F.concat(F.lit("set_"), "o_orderstatus").alias("evidence_set"), F.col("o_orderpriority").alias("biotype")).filter("biotype < '4'").distinct()
    found = refinement.by_evidence_set(t.transcripts(spark, sf).drop("exons"), sets)
    return found.groupBy("evidence_set", "biotype").agg(F.count(F.lit(1)).alias("models"))


QUERIES = {
    f.__name__: f
    for f in (
        flagged_models, accepted_reads, internal_stops, tailless_sequences, model_keys, supported_exons, merged_protein_hits, processed_clusters,
        capped_hits, pruned_hits, identity_summary, evidence_sets,
    )
}

_GAPS = """gaps AS (SELECT gene_id, region, strand, "end" + 1 AS i_start, lead("start") OVER (PARTITION BY gene_id ORDER BY "start", "end") - 1 AS i_end FROM exons)"""

ORACLE_SQL = {
    "flagged_models": f"""WITH {t.EXONS}, {t.TRANSCRIPTS}, {_GAPS}, facts AS (
  SELECT gene_id, count(*) FILTER (n < 14) AS short, count(*) AS n, count(*) FILTER (n >= 14 AND n % 7 = 0) AS odd FROM (SELECT gene_id, i_end - i_start + 1 AS n FROM gaps WHERE i_end IS NOT NULL) GROUP BY 1
), rows AS (SELECT gene_id, coalesce(short, 0) AS short, coalesce(n, 0) AS n, coalesce(odd, 0) AS odd, ['ATG', 'CTG'][(("start" % 2 + 2) % 2 + 1)::INTEGER] AS f, ['TAA', 'TAG', 'TGA', 'GCC'][(("end" % 4 + 4) % 4 + 1)::INTEGER] AS l
  FROM transcripts LEFT JOIN facts USING (gene_id) WHERE biotype <> '1-URGENT')
SELECT gene_id, short > 0 AS frameshift, short > 0 AND short = n AS only_frameshift, odd > 0 AS non_canonical, NOT ((f = 'ATG' AND l = 'TAG') OR l IN ('TAA', 'TGA')) AS incomplete, short > 0 OR odd > 0 AS flag FROM rows""",
    "accepted_reads": f"""WITH {t.EXONS}, whole AS (
  SELECT gene_id, count(*) AS parts, min(identity) AS i, min(coverage) AS c, round(100 * sum(hit % 5) / sum("end" - "start" + 1), 4) AS mismatch FROM exons GROUP BY 1)
SELECT gene_id, parts, mismatch FROM whole WHERE parts > 1 AND i >= 91 AND c >= 93 AND mismatch <= 8""",
    "internal_stops": f"""WITH {t.SEQUENCES.strip()}, peptides AS ({_peptide(0)}), cut AS (SELECT seq_id, coalesce(peptide, '') AS p FROM sequences LEFT JOIN peptides USING (seq_id)),
inner_part AS (SELECT seq_id, p, regexp_replace(p, '\\*$', '') AS i FROM cut)
SELECT seq_id, (length(i) - length(replace(i, '*', '')))::BIGINT AS stops, p <> '*' AND NOT regexp_matches(i, '\\*X|X\\*') AND length(i) - length(replace(i, '*', '')) <= 2 AS fixable FROM inner_part""",
    "model_keys": f"""WITH {t.EXONS}, own AS (
  SELECT gene_id, region || ':' || strand AS place, string_agg("start" || ':' || "end", ':' ORDER BY "start", "end") AS b, count(*) AS n FROM exons GROUP BY 1, 2)
SELECT gene_id, md5(place || '|' || b) AS exon_key, CASE WHEN n > 1 THEN md5(place || '|' || regexp_replace(regexp_replace(b, '^-?\\d+:', ''), ':-?\\d+$', '')) END AS intron_key FROM own""",
    "supported_exons": f"""WITH {t.EXONS}, {t.FEATURES}, own AS (SELECT DISTINCT gene_id, region, strand, "start", "end" FROM exons), hit AS (
  SELECT DISTINCT o.gene_id AS gene_id, o."start" AS s, o."end" AS e FROM own o JOIN features f ON f.flag = 'A' AND f.region = o.region AND f.strand = o.strand AND 2 * f."start" <= o."end" AND 2 * f."end" >= o."start"
), whole AS (SELECT gene_id, count(*) AS exons FROM own GROUP BY 1), good AS (SELECT gene_id, count(*) AS supported FROM hit GROUP BY 1)
SELECT gene_id, exons, coalesce(supported, 0) AS supported, round(coalesce(supported, 0) / exons, 4) AS share FROM whole LEFT JOIN good USING (gene_id)""",
    "merged_protein_hits": f"""WITH {t.EXONS}, placed AS (SELECT *, CASE WHEN strand = 1 THEN rank ELSE 8 - rank END * 20 - 19 AS hs FROM exons),
hits AS (SELECT region, strand, hit % 40 AS protein, "start", "end", hs, hs + "end" - "start" AS he FROM placed), marked AS (
  SELECT *, CASE WHEN "start" - max("end") OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 <= 400 AND strand * (hs - lag(hs) OVER w) > 0 THEN 0 ELSE 1 END AS opens
  FROM hits WINDOW w AS (PARTITION BY region, strand, protein ORDER BY "start", "end", hs, he)
), runs AS (SELECT *, (sum(opens) OVER (PARTITION BY region, strand, protein ORDER BY "start", "end", hs, he ROWS UNBOUNDED PRECEDING))::BIGINT AS run FROM marked), reached AS (
  SELECT *, max(he) OVER (PARTITION BY region, strand, protein, run ORDER BY hs, he ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM runs
), lengths AS (SELECT p_partkey % 40 AS protein, max(p_size) + 150 AS n FROM part GROUP BY 1)
SELECT region, strand, protein, run, min("start") AS "start", max("end") AS "end", round(100 * sum(greatest(he - greatest(coalesce(reach + 1, hs), hs) + 1, 0)) / any_value(n), 1) AS percent
FROM reached JOIN lengths USING (protein) GROUP BY 1, 2, 3, 4""",
    "processed_clusters": _ROOTS + f""", {_GAPS}, pairs AS (SELECT DISTINCT gene_id, region, strand, i_start, i_end FROM gaps WHERE i_end IS NOT NULL), shared AS (
  SELECT gene_id, count(*) OVER (PARTITION BY region, strand, i_start, i_end) AS n FROM pairs), support AS (SELECT gene_id, round(avg(n), 4) AS support FROM shared GROUP BY 1), facts AS (
  SELECT gene_id, round(max(coverage) + max(identity), 4) AS total, sum("end" - "start" + 1) AS len FROM exons GROUP BY 1), rows AS (
  SELECT cluster, gene_id, total, len, coalesce(support >= 1.2, FALSE) AS good FROM roots JOIN facts USING (gene_id) LEFT JOIN support USING (gene_id)), backup AS (
  SELECT gene_id FROM rows QUALIFY NOT bool_or(good) OVER (PARTITION BY cluster) AND row_number() OVER (PARTITION BY cluster ORDER BY total DESC, len DESC, gene_id) = 1)
SELECT gene_id, 'supported' AS way FROM rows WHERE good UNION ALL SELECT gene_id, 'backup' FROM backup""",
    "identity_summary": f"""WITH {t.FEATURES}
SELECT flag, (CASE WHEN identity >= 98 THEN 1 WHEN identity >= 95 THEN 2 WHEN identity >= 92 THEN 3 ELSE 4 END)::INTEGER AS tier, count(*) AS n, min(identity) AS least, round(avg(identity), 4) AS mean, max(identity) AS most
FROM features GROUP BY 1, 2""",
    "evidence_sets": f"""WITH {t.EXONS}, {t.TRANSCRIPTS}, sets AS (SELECT o_orderpriority AS biotype, min('set_' || o_orderstatus) AS evidence_set FROM orders WHERE o_orderpriority < '4' GROUP BY 1)
SELECT evidence_set, biotype, count(*) AS models FROM transcripts LEFT JOIN sets USING (biotype) GROUP BY 1, 2""",
}
