"""Curation rules over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as q
from ..operators import clusters, curation, models
from ..sources import driver_tables as t
from .building_queries import _BASE, _ROOTS, _shaped
from .model_queries import _peptide

STRANDED = ["region", "strand"]
SPARSE = 1024


def _facts(spark, sf):
    """Models with n_exons, length and locus."""
    return t.transcripts(spark, sf).withColumns({"n_exons": F.size("exons").cast("long"), "length": models.total_length("exons"), "locus": F.floor(F.col("gene_id") / 8).cast("long")})


def redundant_coding(spark, sf):
    first = F.get("exons", F.lit(0))
    rows = t.transcripts(spark, sf).withColumns({"coding": F.concat_ws(":", first["start"], first["end"]), "has_utr": F.col("source") == "F"})
    return curation.without_redundant_coding(rows, STRANDED, "coding", "has_utr", ["1-URGENT"]).select("gene_id", "biotype")


def backup_models(spark, sf):
    support = t.exons(spark, sf).groupBy("gene_id").agg((F.max("score") / 1000).alias("support"), F.max("coverage").alias("coverage"), F.max("identity").alias("identity"))
    rows = _facts(spark, sf).join(support, "gene_id").withColumn("weight", F.col("n_exons"))
    return curation.best_backups(rows, STRANDED, "gene_id", 30, 5)


def noncoding_loci(spark, sf):
    exons = t.exons(spark, sf)
    rows = _facts(spark, sf).filter("biotype = '5-LOW'")
    return curation.noncoding_genes(rows, exons, exons.filter("biotype = '1-URGENT'"), STRANDED, "locus", 60, 3, 100, SPARSE)


def translation_shares(spark, sf):
    first = F.get("exons", F.lit(0))
    rows = _facts(spark, sf).withColumn("residues", F.floor((first["end"] - first["start"] + 1) / 3))
    return curation.long_or_short(rows, "locus", "residues", "length", 30.0)


def loci_after_deletion(spark, sf):
    exons = t.exons(spark, sf)
    deleted = exons.groupBy("gene_id").agg(F.max("hit").alias("hit")).filter("hit % 3 = 0")
    return curation.after_deletion(_facts(spark, sf), exons, deleted, "locus")


def retrotransposed(spark, sf):
    return curation.spliced_elsewhere(_facts(spark, sf), t.exons(spark, sf).select("gene_id", "hit"), "n_exons", "region")


def painted_domains(spark, sf):
    """What is seen of each hit of a region when higher scores lie over lower ones."""
    hits = t.features(spark, sf).select("region", "start", "end", "score", F.xxhash64("gene_id", "start", "end", "score", "hit").alias("row_id"))
    # equal scores and places are one hit
    one = hits.groupBy("region", "start", "end", "score").agg(F.min("row_id").alias("row_id"))
    seen = curation.painted(one, ["region"], "score", "row_id").join(one.select("row_id", "score", F.lit(1).alias("_k")), "row_id")
    return seen.groupBy("region", "score").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


def split_gene_pairs(spark, sf):
    parts = t.exons(spark, sf).withColumns({"family": F.col("hit") % 10, "hit_start": F.col("rank") * 10, "hit_end": F.col("rank") * 10 + 9})
    return curation.split_genes(parts, ["region", "strand", "family"], "gene_id")


def evidence_choice(spark, sf):
    found = curation.chosen_by_precedence(t.exons(spark, sf), "hit", ["F", "O"], "biotype", "gene_id")
    return found.select("hit", "gene_id", "source", F.round(F.col("identity") + F.col("coverage"), 4).alias("total"))


def moved_evidence(spark, sf):
    return curation.transferred_evidence(_facts(spark, sf), t.exons(spark, sf).select("gene_id", "hit"), ["region", "strand", "length"])


def evidence_lineage(spark, sf):
    lines = t.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("feature"))
    parts = t.table(spark, sf, "part").select(F.col("p_partkey").alias("evidence"))
    evidence = parts.join(lines.select(F.col("l_partkey").alias("evidence"), "feature"), "evidence", "left")
    genes = t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("gene_id"), F.col("o_custkey").alias("gene"))
    return curation.lineage(evidence, lines.select("feature", F.col("l_orderkey").alias("gene_id")), genes)


def recovered_models(spark, sf):
    shaped, exons = _shaped(spark, sf), t.exons(spark, sf)
    return curation.recovered(shaped.filter("source = 'O'"), exons.filter("source = 'O'"), shaped.filter("source = 'F'"), exons.filter("source = 'F'"), "chain", STRANDED, SPARSE)


def model_labels(spark, sf):
    found = curation.labelled_models(_facts(spark, sf), "locus", [F.desc("length"), F.col("biotype"), F.col("gene_id")], F.col("n_exons") >= 4)
    return found.select("gene_id", "locus", "label")


def renamed_biotypes(spark, sf):
    found = curation.renamed_by_filter(_facts(spark, sf), F.col("n_exons") >= 5, "_long")
    return found.groupBy("biotype").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))


def utr_scores(spark, sf):
    ends = t.exons(spark, sf).groupBy("gene_id").agg(
        (10 * F.min_by(F.col("end") - F.col("start"), "rank") - 20).alias("five"), (10 * F.max_by(F.col("end") - F.col("start"), "rank") - 20).alias("three"), F.count_if(F.col("hit") % 10 == 0).alias("tags")
    )
    return curation.utr_scores(ends, "five", "three", "tags").select("gene_id", "utr_score")


def trimmed_utr_exons(spark, sf):
    middle = t.exons(spark, sf)
    sizes = middle.groupBy("gene_id").agg(F.floor((F.max("rank") + 1) / 2).alias("rank"))
    spans = middle.join(sizes, ["gene_id", "rank"]).select("gene_id", F.col("start").alias("low"), F.col("end").alias("high"))
    kept = curation.trimmed_utr(middle.select("gene_id", "start", "end").join(spans, "gene_id"), "low", "high", 1)
    return kept.groupBy("gene_id").agg(F.count(F.lit(1)).alias("exons"), F.min("start").alias("start"), F.max("end").alias("end"))


def _clusters(spark, sf):
    return clusters.exon_clusters(t.exons(spark, sf), STRANDED, scan_bin=SPARSE)


def sources_of_clusters(spark, sf):
    found = curation.cluster_sources(_clusters(spark, sf), t.transcripts(spark, sf), "source")
    return found.select("cluster", "source", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


def extents_of_clusters(spark, sf):
    return curation.cluster_extents(_clusters(spark, sf), t.transcripts(spark, sf))


def cut_blocks(spark, sf):
    rows = t.features(spark, sf).withColumns({"target_start": F.col("hit"), "orientation": F.when(F.col("hit") % 2 == 0, 1).otherwise(-1)})
    cut = curation.restricted(rows, F.lit(500), F.lit(1500))
    return cut.groupBy("region").agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.sum("target_start").alias("target"))


def slice_features(spark, sf):
    rows = t.features(spark, sf).select("region", "strand", "start", "end")
    regions = rows.select("region").distinct()
    slices = regions.select("region", F.explode(F.array(*[F.struct(F.lit(a).alias("slice_start"), F.lit(b).alias("slice_end"), F.lit(o).alias("slice_strand")) for a, b, o in ((1, 1000, 1), (1001, 2000, -1))])).alias("s"))
    held = curation.to_slice(rows, slices.select("region", "s.*"), ["region"])
    return held.groupBy("region", "slice_start", "strand").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


def broken_features(spark, sf):
    rules = {"order": F.col("start") <= F.col("end"), "identity": F.col("identity") >= 92, "coverage": F.col("coverage").between(0, 97), "strand": F.col("strand").isin(-1, 0, 1)}
    return curation.invalid_features(t.features(spark, sf), rules)


def base_runs(spark, sf):
    return curation.base_runs(t.sequences(spark, sf), "AT", 7)


def extended_coding(spark, sf):
    low = (1 + F.col("seq_id") % 90).cast("long")
    rows = t.sequences(spark, sf).withColumns({"cds_start": low, "cds_end": low + 3 * (10 + F.col("seq_id") % 50) - 1}).filter(F.length("seq") > F.col("cds_end") + 3)
    return curation.extended_codons(rows).select("seq_id", "cds_start", "cds_end")


def translation_choice(spark, sf):
    peptides = F.array(*[q.translated(F.col("seq"), f) for f in range(3)])
    frames = t.sequences(spark, sf).select("seq_id", F.explode(peptides).alias("p")).select("seq_id", F.explode(F.split("p", r"\*", -1)).alias("piece"))
    return curation.best_translation(frames)


def _buildable(spark, sf):
    first = F.get("exons", F.lit(0))
    return _facts(spark, sf).withColumns({"coding": F.concat_ws(":", first["start"], first["end"]), "has_utr": F.col("source") == "F", "order": -F.col("length")})


def pruned_models(spark, sf):
    return curation.pruned_by_exon_pairs(_buildable(spark, sf), STRANDED, ["order"], ["1-URGENT"], (5, 15))


def gene_set(spark, sf):
    return curation.built_genes(_buildable(spark, sf), STRANDED, ["order"], ["1-URGENT"], (5, 15), 3)


QUERIES = {
    f.__name__: f
    for f in (
        redundant_coding, backup_models, noncoding_loci, translation_shares, loci_after_deletion, retrotransposed, painted_domains, split_gene_pairs, evidence_choice,
        moved_evidence, evidence_lineage, recovered_models, model_labels, renamed_biotypes, utr_scores, trimmed_utr_exons, sources_of_clusters,
        extents_of_clusters, cut_blocks, slice_features, broken_features, base_runs, extended_coding, translation_choice, pruned_models, gene_set,
    )
}

_FACTS = f"""WITH {t.EXONS}, facts AS (
  SELECT gene_id, region, strand, biotype, source, gene_id // 8 AS locus, count(*) AS n_exons, sum("end" - "start" + 1)::BIGINT AS len, min("start") AS "start", max("end") AS "end",
    max(score) / 1000 AS support, max(coverage) AS coverage, max(identity) AS identity, max(hit) AS hit FROM exons GROUP BY ALL
)"""
_NOT_BLESSED = "CASE WHEN given IS NOT NULL AND biotype <> '1-URGENT' THEN given ELSE biotype END"

ORACLE_SQL = {
    "redundant_coding": f"""WITH {t.EXONS}, m AS (SELECT gene_id, region, strand, biotype, source = 'F' AS has_utr, "start" || ':' || "end" AS coding FROM exons WHERE rank = 1),
given AS (SELECT region, strand, coding, min(biotype) AS given FROM m WHERE NOT has_utr AND biotype = '1-URGENT' GROUP BY 1, 2, 3)
SELECT gene_id, {_NOT_BLESSED} AS biotype FROM m LEFT JOIN given USING (region, strand, coding) WHERE has_utr
UNION ALL SELECT gene_id, biotype FROM m WHERE NOT has_utr AND NOT EXISTS (SELECT 1 FROM m x WHERE x.has_utr AND x.region = m.region AND x.strand = m.strand AND x.coding = m.coding)""",
    "backup_models": _FACTS + """, fit AS (
  SELECT *, min(n_exons) OVER (PARTITION BY region, strand ORDER BY gene_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM facts WHERE support >= 30 AND n_exons <= 5)
SELECT region, strand, gene_id FROM fit WHERE before IS NULL OR n_exons <= before
QUALIFY row_number() OVER (PARTITION BY region, strand ORDER BY coverage + identity DESC, len DESC, gene_id) = 1""",
    "noncoding_loci": _FACTS + """
SELECT DISTINCT locus FROM facts WHERE biotype = '5-LOW' AND len >= 60 AND (n_exons >= 3 OR len >= 100) AND locus NOT IN (
  SELECT a.gene_id // 8 FROM exons a JOIN exons b ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start" WHERE a.biotype = '5-LOW' AND b.biotype = '1-URGENT')""",
    "translation_shares": _FACTS + """, first AS (SELECT gene_id, ("end" - "start" + 1) // 3 AS residues FROM exons WHERE rank = 1),
best AS (SELECT locus, max(round(3.0::DOUBLE * residues * 100 / len, 1)) AS ratio FROM facts JOIN first USING (gene_id) GROUP BY 1)
SELECT locus, ratio, CASE WHEN ratio > 30 THEN 'long' ELSE 'short' END AS kind FROM best""",
    "loci_after_deletion": _FACTS + """
SELECT locus, min("start") AS "start", max("end") AS "end", count(*) AS models FROM facts WHERE hit % 3 <> 0 GROUP BY 1""",
    "retrotransposed": _FACTS + """, e AS (SELECT DISTINCT gene_id, f.region, f.n_exons, x.hit AS piece FROM facts f JOIN exons x USING (gene_id))
SELECT a.gene_id AS gene_id, count(DISTINCT a.piece) AS evidence FROM e a JOIN e b ON a.piece = b.piece AND b.n_exons > 1 AND b.region <> a.region WHERE a.n_exons = 1 GROUP BY 1""",
    "painted_domains": f"""WITH {t.FEATURES}, bases AS (SELECT region, score, unnest(range("start", "end" + 1)) AS pos FROM features),
tops AS (SELECT region, pos, max(score) AS score FROM bases GROUP BY 1, 2)
SELECT region, score, count(*)::BIGINT AS bases FROM tops GROUP BY 1, 2""",
    "split_gene_pairs": f"""WITH {t.EXONS}, parts AS (SELECT *, hit % 10 AS family, rank * 10 AS hs, rank * 10 + 9 AS he FROM exons), pairs AS (
  SELECT region, strand, family, gene_id AS a, lead(gene_id) OVER w AS b, lead("start") OVER w > "end" AND lead(hs) OVER w > he AS apart FROM parts
  WINDOW w AS (PARTITION BY region, strand, family ORDER BY "start", "end", gene_id))
SELECT region, strand, family, a, b FROM pairs WHERE apart""",
    "evidence_choice": f"""WITH {t.EXONS}
SELECT hit, gene_id, source, round(identity + coverage, 4) AS total FROM exons QUALIFY row_number() OVER (
  PARTITION BY hit ORDER BY round(identity + coverage, 4) DESC, CASE source WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, biotype, gene_id) = 1""",
    "moved_evidence": _FACTS + """, kept AS (SELECT gene_id, min(gene_id) OVER (PARTITION BY region, strand, len) AS k FROM facts)
SELECT k AS gene_id, x.hit AS hit, bool_or(x.gene_id = k) AS own FROM kept JOIN exons x USING (gene_id) GROUP BY 1, 2""",
    "evidence_lineage": """SELECT p_partkey AS evidence, count(DISTINCT l_orderkey * 10 + l_linenumber) AS features, count(DISTINCT l_orderkey) AS models, count(DISTINCT o_custkey) AS genes
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
    "recovered_models": f"""{_BASE}, fresh AS (SELECT gene_id FROM shaped s WHERE source = 'O' AND NOT EXISTS (
  SELECT 1 FROM shaped m WHERE m.source = 'F' AND m.region = s.region AND m.strand = s.strand AND m.chain = s.chain)), met AS (
  SELECT DISTINCT a.gene_id AS gene_id FROM exons a JOIN exons b ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start" WHERE b.source = 'F')
SELECT gene_id, CASE WHEN gene_id IN (SELECT gene_id FROM met) THEN 'variant' ELSE 'missed' END AS way FROM fresh""",
    "model_labels": _FACTS + """
SELECT gene_id, locus, CASE WHEN row_number() OVER (PARTITION BY locus ORDER BY len DESC, biotype, gene_id) = 1 THEN 'canonical'
  WHEN n_exons >= 4 OR NOT bool_or(n_exons >= 4) OVER (PARTITION BY locus) THEN 'basic' ELSE 'alternative' END AS label FROM facts""",
    "renamed_biotypes": _FACTS + """
SELECT CASE WHEN n_exons >= 5 THEN biotype || '_long' ELSE biotype END AS biotype, count(*) AS n, sum(len)::BIGINT AS length FROM facts GROUP BY 1""",
    "utr_scores": f"""WITH {t.EXONS}, ends AS (
  SELECT gene_id, 10 * arg_min("end" - "start", rank) - 20 AS five, 10 * arg_max("end" - "start", rank) - 20 AS three, count(*) FILTER (hit % 10 = 0) AS tags FROM exons GROUP BY 1)
SELECT gene_id, (CASE WHEN five > 0 THEN 1 + least(five // 100, 5) ELSE 0 END + CASE WHEN three > 0 THEN 1 + least(three // 100, 5) ELSE 0 END + 2 * tags)::BIGINT AS utr_score FROM ends""",
    "trimmed_utr_exons": f"""WITH {t.EXONS}, sizes AS (SELECT gene_id, (max(rank) + 1) // 2 AS mid FROM exons GROUP BY 1)
SELECT gene_id, count(*) AS exons, min("start") AS "start", max("end") AS "end" FROM exons JOIN sizes USING (gene_id) WHERE abs(rank - mid) <= 1 GROUP BY 1""",
    "sources_of_clusters": _ROOTS + """
SELECT cluster, source, string_agg(gene_id::VARCHAR, ',' ORDER BY gene_id) AS ids FROM roots JOIN (SELECT DISTINCT gene_id, source FROM exons) USING (gene_id) GROUP BY 1, 2""",
    "extents_of_clusters": _ROOTS + """, m AS (SELECT gene_id, strand, min("start") AS s, max("end") AS e FROM exons GROUP BY 1, 2)
SELECT cluster, min(s) AS "start", max(e) AS "end", CASE WHEN max(s) <= min(e) THEN max(s) END AS common_start, CASE WHEN max(s) <= min(e) THEN min(e) END AS common_end,
  count(DISTINCT strand) AS strands FROM roots JOIN m USING (gene_id) GROUP BY 1""",
    "cut_blocks": f"""WITH {t.FEATURES}, cut AS (SELECT *, greatest("start", 500) AS s, least("end", 1500) AS e FROM features)
SELECT region, count(*) AS blocks, sum(e - s + 1)::BIGINT AS bases, sum(hit + CASE WHEN hit % 2 = 0 THEN s - "start" ELSE "end" - e END)::BIGINT AS target FROM cut WHERE s <= e GROUP BY 1""",
    "slice_features": f"""WITH {t.FEATURES}, slices(a, b, o) AS (VALUES (1, 1000, 1), (1001, 2000, -1)), held AS (
  SELECT region, a AS slice_start, strand * o AS strand, CASE WHEN o = 1 THEN "start" - a + 1 ELSE b - "end" + 1 END AS s, CASE WHEN o = 1 THEN "end" - a + 1 ELSE b - "start" + 1 END AS e
  FROM features JOIN slices ON "start" >= a AND "end" <= b)
SELECT region, slice_start, strand, count(*) AS n, sum(s)::BIGINT AS starts, sum(e)::BIGINT AS ends FROM held GROUP BY 1, 2, 3""",
    "broken_features": f"""WITH {t.FEATURES}, r AS (
  SELECT 'order' AS rule, count(*) AS n FROM features WHERE NOT coalesce("start" <= "end", FALSE) UNION ALL SELECT 'identity', count(*) FROM features WHERE NOT coalesce(identity >= 92, FALSE)
  UNION ALL SELECT 'coverage', count(*) FROM features WHERE NOT coalesce(coverage BETWEEN 0 AND 97, FALSE) UNION ALL SELECT 'strand', count(*) FROM features WHERE NOT coalesce(strand IN (-1, 0, 1), FALSE))
SELECT * FROM r WHERE n > 0""",
    "base_runs": f"""WITH {t.SEQUENCES}, cut AS (SELECT seq_id, regexp_extract_all(seq, '[AT]{{7,}}') AS runs, string_split_regex(seq, '[AT]{{7,}}') AS gaps FROM sequences), pieces AS (
  SELECT seq_id, unnest(range(1, len(runs) + 1)) AS i, unnest(runs) AS run, unnest(gaps[1:len(runs)]) AS gap FROM cut WHERE len(runs) > 0), placed AS (
  SELECT seq_id, length(run) AS n, sum(length(gap) + length(run)) OVER (PARTITION BY seq_id ORDER BY i)::BIGINT AS "end" FROM pieces)
SELECT seq_id, "end" - n + 1 AS "start", "end" FROM placed""",
    "extended_coding": f"""WITH {t.SEQUENCES}, spans AS (SELECT seq_id, seq, 1 + seq_id % 90 AS s, seq_id % 90 + 3 * (10 + seq_id % 50) AS e FROM sequences)
SELECT seq_id, CASE WHEN substr(seq, s, 3) <> 'ATG' AND s > 3 AND substr(seq, greatest(s - 3, 1), 3) = 'ATG' THEN s - 3 ELSE s END AS cds_start,
  CASE WHEN substr(seq, e - 2, 3) NOT IN ('TAA', 'TAG', 'TGA') AND substr(seq, e + 1, 3) IN ('TAA', 'TAG', 'TGA') THEN e + 3 ELSE e END AS cds_end FROM spans WHERE length(seq) > e + 3""",
    "translation_choice": f"""WITH {t.SEQUENCES}, peptides AS ({_peptide(0)} UNION ALL {_peptide(1)} UNION ALL {_peptide(2)}), pieces AS (SELECT seq_id, unnest(string_split(peptide, '*')) AS piece FROM peptides), best AS (
  SELECT seq_id, max(CASE WHEN contains(piece, 'M') THEN length(piece) - instr(piece, 'M') + 1 END)::BIGINT AS met, max(length(piece))::BIGINT AS open FROM pieces WHERE piece <> '' GROUP BY 1)
SELECT seq_id, met, open, CASE WHEN met IS NULL OR open > 2 * met THEN 'open' ELSE 'met' END AS choice FROM best""",
}
