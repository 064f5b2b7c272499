"""Maps between sequences, alignments of pairs, clusters by introns, cuts and fetched parts, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import alignment, factories, hits, intervals, projection, sequences
from ..sources import driver_tables as t

STRANDED = ["region", "strand"]
SPARSE = 1024
#: Bases of a chunk of the sequence table.
CHUNK = 500


def map_blocks(spark, sf):
    """Ungapped blocks between a region and its other form: an order lies at its day on one side, shifted by its priority and
    status on the other."""
    orders = t.table(spark, sf, "orders")
    start = 20 * t._days("o_orderdate") + 1
    shift = 40 * F.substr("o_orderpriority", F.lit(1), F.lit(1)).cast("long") + F.when(F.col("o_orderstatus") == "O", 15).otherwise(0)
    return orders.select(
        F.col("o_orderkey").alias("block_id"), F.floor(F.col("o_custkey") / t.CUSTOMERS_PER_REGION).cast("long").alias("region"), start.cast("long").alias("start"),
        (start + 30 + F.col("o_orderkey") % 90).cast("long").alias("end"), (start + shift).cast("long").alias("target_start"), F.col("o_totalprice").alias("score"),
    )


def one_to_one_blocks(spark, sf):
    return projection.one_to_one(map_blocks(spark, sf), ["region"], "block_id", "score")


def haplotype_models(spark, sf):
    """Models through islands of features, which are apart on either side: the other form lacks 3 bases before each island."""
    islands = intervals.merged(t.features(spark, sf).filter("flag = 'R'"), ["region"], scan_bin=64)
    scaled = islands.select("region", (F.col("start") * 20).alias("start"), (F.col("end") * 20 + 19).alias("end"))
    number = F.row_number().over(Window.partitionBy("region").orderBy("start"))
    blocks = scaled.withColumns({"target_start": F.col("start") - 3 * number, "target": F.concat(F.lit("h"), "region"), "orientation": F.lit(1)})
    exons = t.exons(spark, sf).select("gene_id", "region", "rank", "start", "end", (F.col("rank") % 2 == 1).alias("coding"))
    return projection.projected_models(exons, blocks, ["region"], 3, SPARSE)


def aligned_names(spark, sf):
    """Each part's name against the next ones of its brand and type, letters for residues."""
    parts = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    order = Window.partitionBy("p_brand", "p_type").orderBy("p_partkey")
    later = parts.withColumn("_next", F.array(F.lead("p_name", 1).over(order), F.lead("p_name", 2).over(order))).withColumn("other", F.explode("_next"))
    found = alignment.identities(later.filter("other IS NOT NULL").select("p_partkey", "p_name", "other"), "p_name", "other")
    return found.select("p_partkey", "other", "score", "identical", "aligned", "identity", "coverage")


def best_aligned_names(spark, sf):
    """Of a part's candidates the one that it is aligned to best."""
    found = aligned_names(spark, sf).withColumn("candidate", F.xxhash64("other"))
    return alignment.best_alignments(found, "p_partkey", "candidate").select("p_partkey", "other", "identity", "coverage")


def intron_consistent_clusters(spark, sf):
    models = t.snapped(spark, sf).groupBy("gene_id", *STRANDED).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("e"))
    pick = lambda c: F.transform("e", lambda x: x[c]).alias(f"{c}s")
    return hits.intron_clusters(models.select("gene_id", *STRANDED, pick("start"), pick("end")), STRANDED, "gene_id", 4096)


def low_coverage_slices(spark, sf):
    features = t.features(spark, sf)
    regions = features.groupBy("region").agg(F.max("end").alias("length"))
    return factories.low_coverage_cuts(regions, intervals.depth(features, ["region"], 64), 60, 10, 100, 20, 5)


def fetched_sequences(spark, sf):
    """Three parts of each sequence: over its first chunk border, around its middle, and over its end."""
    seqs = t.sequences(spark, sf).filter(F.length("seq") > 0)
    n = F.length("seq").cast("long")
    places = F.array(*[F.struct(F.lit(i).alias("part"), a.cast("long").alias("start"), b.cast("long").alias("end"), F.lit(s).alias("strand")) for i, a, b, s in (
        (0, F.lit(CHUNK - 20), F.lit(CHUNK + 20), 1), (1, F.greatest(F.floor(n / 2) - 700, F.lit(1)), F.floor(n / 2) + 700, -1), (2, F.greatest(n - 30, F.lit(1)), n + 50, -1),
    )])
    regions = seqs.select("seq_id", F.explode(places).alias("p")).select("seq_id", "p.*").withColumn("region_id", F.concat_ws(":", "seq_id", "part"))
    found = sequences.fetched(regions, sequences.chunked(seqs, CHUNK), CHUNK)
    return found.select("seq_id", F.col("part").cast("int").alias("part"), F.coalesce(F.length("seq"), F.lit(0)).cast("long").alias("length"), F.md5("seq").alias("digest"))


QUERIES = {
    f.__name__: f for f in (one_to_one_blocks, haplotype_models, aligned_names, best_aligned_names, intron_consistent_clusters, low_coverage_slices, fetched_sequences)
}

ORACLE_SQL = {
    "haplotype_models": f"""WITH {t.EXONS}, {t.FEATURES}, marked AS (
  SELECT *, CASE WHEN "start" > max("end") OVER (PARTITION BY region ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM features WHERE flag = 'R'
), islands AS (
  SELECT region, 20 * min("start") AS b, 20 * max("end") + 19 AS e FROM (SELECT *, sum(opens) OVER (PARTITION BY region ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM marked) GROUP BY region, island
), blocks AS (SELECT *, b - 3 * row_number() OVER (PARTITION BY region ORDER BY b) - b AS shift FROM islands
), pieces AS (
  SELECT gene_id, x.region AS region, rank, "end" - "start" + 1 AS len, greatest("start", b) AS lo, least("end", e) AS hi, shift FROM exons x JOIN blocks k ON x.region = k.region AND x."start" <= e AND x."end" >= b
), stepped AS (
  SELECT *, CASE WHEN lo - lag(hi) OVER w - 1 <= 3 AND (lo + shift) - lag(hi + shift) OVER w - 1 BETWEEN 0 AND 3 THEN 0 ELSE 1 END AS opens FROM pieces WINDOW w AS (PARTITION BY gene_id, rank ORDER BY lo)
), runs AS (
  SELECT gene_id, rank, any_value(len) AS len, sum(hi - lo + 1) AS bases FROM (SELECT *, sum(opens) OVER (PARTITION BY gene_id, rank ORDER BY lo ROWS UNBOUNDED PRECEDING) AS run FROM stepped) GROUP BY gene_id, rank, run
), states AS (SELECT gene_id, rank, bool_or(bases = len) AS whole FROM runs GROUP BY 1, 2
), totals AS (SELECT gene_id, sum(hi - lo + 1)::BIGINT AS mapped, 'h' || any_value(region) AS target, min(lo + shift) AS target_start, max(hi + shift) AS target_end FROM pieces GROUP BY 1
), facts AS (
  SELECT gene_id, count(*) AS exons, count(*) FILTER (whole) AS whole, count(*) FILTER (NOT whole) AS cut, count(*) FILTER (whole IS NULL) AS lost,
    count(*) FILTER (rank % 2 = 1 AND NOT coalesce(whole, FALSE)) AS broken, count(*) FILTER (rank % 2 = 1) AS coding FROM exons LEFT JOIN states USING (gene_id, rank) GROUP BY 1)
SELECT gene_id, CASE WHEN whole = exons THEN 'complete' WHEN coding > 0 AND broken = 0 THEN 'coding' WHEN mapped > 0 THEN 'partial' ELSE 'lost' END AS status, exons, whole, cut, lost,
  coalesce(mapped, 0)::BIGINT AS mapped, target, target_start, target_end FROM facts LEFT JOIN totals USING (gene_id)""",
    "low_coverage_slices": f"""WITH RECURSIVE {t.FEATURES.strip()}, regions AS (SELECT region, max("end") AS length FROM features GROUP BY 1
), bases AS (SELECT region, pos, count(*) AS depth FROM (SELECT region, unnest(generate_series("start", "end")) AS pos FROM features) GROUP BY 1, 2
), every AS (SELECT region, length, pos FROM regions, LATERAL (SELECT unnest(generate_series(-1, length)) AS pos)
), deep AS (SELECT e.region AS region, length, e.pos AS pos, sum(CASE WHEN depth > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY e.region ORDER BY e.pos ROWS UNBOUNDED PRECEDING) AS n FROM every e LEFT JOIN bases d ON d.region IS NOT DISTINCT FROM e.region AND d.pos = e.pos
), windows AS (SELECT a.region AS region, a.length AS length, a.pos + 2 AS pos, b.n - a.n < 20 AS low FROM deep a JOIN deep b ON a.region IS NOT DISTINCT FROM b.region AND b.pos = a.pos + 60
), walk AS (
  SELECT region, length, 1 AS begin, 100 AS pos, NULL::BIGINT AS s, NULL::BIGINT AS e, FALSE AS done FROM regions
  UNION ALL
  SELECT k.region, k.length, CASE WHEN w.low THEN w.pos + 31 ELSE k.begin END, CASE WHEN w.low THEN w.pos + 130 ELSE k.pos + 10 END, CASE WHEN w.low THEN k.begin END, CASE WHEN w.low THEN w.pos + 30 END,
    w.low AND (w.pos + 31 >= k.length OR w.pos + 131 >= k.length)
  FROM walk k JOIN windows w ON w.region IS NOT DISTINCT FROM k.region AND w.pos = k.pos WHERE NOT k.done AND k.pos < k.length - 60
)
SELECT region, s AS "start", e AS "end" FROM walk WHERE s IS NOT NULL
UNION ALL SELECT region, begin, length FROM (SELECT region, max(begin) AS begin, any_value(length) AS length FROM walk GROUP BY 1) WHERE begin < length OR begin = 1""",
    "fetched_sequences": f"""WITH {t.SEQUENCES.strip()}, sized AS (SELECT seq_id, seq, length(seq) AS n FROM sequences WHERE length(seq) > 0), places AS (
  SELECT seq_id, seq, 0 AS part, 480 AS s, 520 AS e, 1 AS strand FROM sized
  UNION ALL SELECT seq_id, seq, 1, greatest(n // 2 - 700, 1), n // 2 + 700, -1 FROM sized UNION ALL SELECT seq_id, seq, 2, greatest(n - 30, 1), n + 50, -1 FROM sized
), cut AS (SELECT seq_id, part, CASE WHEN strand = 1 THEN substr(seq, s, e - s + 1) ELSE reverse(translate(substr(seq, s, e - s + 1), 'ACGT', 'TGCA')) END AS q FROM places)
SELECT seq_id, part::INTEGER AS part, length(q) AS length, CASE WHEN q <> '' THEN md5(q) END AS digest FROM cut""",
}
