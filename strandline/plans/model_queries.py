"""Gene models, sequences, projection, audits and work units over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as q
from ..operators import audit, factories, models, projection
from ..operators.graph import checkpointed
from ..sources import driver_tables as t

STRANDED = ["region", "strand"]
SPARSE = 1024


def intron_facts(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("introns", models.introns(F.col("exons")))
    return genes.select(
        "gene_id",
        F.size("introns").cast("long").alias("n_introns"),
        models.total_length("introns").alias("intron_length"),
        models.total_length("exons").alias("exon_length"),
        F.array_max(F.transform("introns", lambda i: i["end"] - i["start"] + 1)).alias("longest"),
        F.exists("introns", lambda i: i["end"] - i["start"] + 1 < 15).alias("has_short"),
    )


def intron_chains(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("chain", models.chain_key(models.introns(F.col("exons"))))
    same = genes.filter("chain <> ''").groupBy(*STRANDED, "chain").agg(F.count(F.lit(1)).alias("genes"), F.min("gene_id").alias("first_gene"))
    return same


def split_models(spark, sf):
    parts = models.split_on_introns(t.transcripts(spark, sf), longest=45)
    return parts.select("gene_id", F.col("part").cast("long").alias("part"), F.size("exons").cast("long").alias("n_exons"), "start", "end")


def trimmed_models(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("kept", models.trimmed_ends(F.col("exons"), 15)).filter(F.size("kept") > 0)
    return genes.select("gene_id", F.size("kept").cast("long").alias("n_exons"), F.array_min(F.transform("kept", lambda e: e["start"])).alias("start"), F.array_max(F.transform("kept", lambda e: e["end"])).alias("end"))


def clipped_models(spark, sf):
    genes = t.transcripts(spark, sf).withColumns({"low": F.col("start") + 10, "high": F.col("end") - 10})
    kept = genes.withColumn("cds", models.clipped(F.col("exons"), F.col("low"), F.col("high"))).filter(F.size("cds") > 0)
    return kept.select("gene_id", F.size("cds").cast("long").alias("n_exons"), models.total_length("cds").alias("cds_length"))


def exon_phases(spark, sf):
    return models.with_phases(t.exons(spark, sf)).select("gene_id", "rank", "phase", "end_phase")


def cdna_positions(spark, sf):
    return models.cdna_position(t.exons(spark, sf)).select("gene_id", "rank", "cdna_start", "cdna_end")


def exon_pair_support(spark, sf):
    return models.exon_pair_support(t.exons(spark, sf), least=2)


def consensus_scores(spark, sf):
    return models.consensus_score(t.exons(spark, sf)).select("gene_id", "rank", "n_same", "n_over", "quotient")


def shared_exons(spark, sf):
    keyed = models.unique_exons(t.exons(spark, sf))
    return keyed.groupBy("exon_key").agg(F.count(F.lit(1)).alias("uses"), F.count_distinct("gene_id").alias("genes")).filter("genes > 1")


def exon_density(spark, sf):
    genes = t.transcripts(spark, sf)
    share = 100 * models.total_length("exons") / (F.col("end") - F.col("start") + 1)
    return genes.groupBy("biotype").agg(F.round(F.avg(share), 6).alias("density"), F.max(F.size("exons")).cast("long").alias("most_exons"))


def longest_model_per_region(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("length", models.total_length("exons"))
    best = genes.groupBy(*STRANDED).agg(F.max_by(F.struct("gene_id", "length"), F.struct("length", -F.col("gene_id"))).alias("b"))
    return best.select(*STRANDED, "b.gene_id", "b.length")


def translations(spark, sf):
    seqs = t.sequences(spark, sf)
    peptide = q.translated(F.col("seq"))
    found = seqs.withColumn("peptide", peptide)
    return found.select("seq_id", F.length("peptide").cast("long").alias("residues"), q.base_count(F.col("peptide"), "*").alias("stops"), F.md5(F.col("peptide").cast("binary")).alias("peptide_md5"))


def best_frames(spark, sf):
    """The longest open frame of each frame of a sequence, from its first M: 0 to 2 ahead, 3 to 5 on the other strand."""
    both = t.sequences(spark, sf).select("seq_id", F.posexplode(F.array("seq", q.reverse_complement(F.col("seq")))).alias("back", "seq"))
    seqs = both.select("seq_id", "seq", F.explode(F.array(*[(3 * F.col("back") + i) for i in range(3)])).alias("frame"))
    at = F.col("frame") % 3
    peptide = F.when(at == 0, q.translated(F.col("seq"), 0)).when(at == 1, q.translated(F.col("seq"), 1)).otherwise(q.translated(F.col("seq"), 2))
    pieces = seqs.select("seq_id", "frame", F.explode(F.split(peptide, r"\*", -1)).alias("piece")).filter(F.contains("piece", F.lit("M")))
    orf = F.length("piece") - F.instr("piece", "M") + 1
    return pieces.groupBy("seq_id", "frame").agg(F.max(orf).cast("long").alias("longest"), F.count(F.lit(1)).alias("frames"))


def composition(spark, sf):
    seqs = t.sequences(spark, sf)
    return seqs.select(
        "seq_id", *[q.base_count(F.col("seq"), b).alias(b.lower()) for b in "ACGT"], q.gc_percent(F.col("seq")).alias("gc"), q.tail_length(F.col("seq")).alias("tail"), q.has_polya_signal(F.col("seq"), "AATA").alias("signal")
    )


def reverse_complements(spark, sf):
    seqs = t.sequences(spark, sf)
    return seqs.select("seq_id", F.md5(q.reverse_complement(F.col("seq")).cast("binary")).alias("rc_md5"))


def projected_exons(spark, sf):
    blocks = t.features(spark, sf).filter("flag = 'A'").select(
        "region", F.col("start") * 20 + 1, F.col("hit").alias("target")
    ).toDF("region", "start", "target").withColumn("end", F.col("start") + 199).withColumn("target_start", F.lit(1).cast("long")).withColumn("orientation", F.when(F.col("target") % 2 == 0, 1).otherwise(-1))
    rows = t.exons(spark, sf).select("gene_id", "region", "start", "end")
    pieces = projection.projected(rows, blocks, ["region"], SPARSE)
    return pieces.groupBy("gene_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.col("target_end") - F.col("target_start") + 1).alias("bases"), F.min("target_start").alias("low"), F.max("target_end").alias("high"))


def integrity(spark, sf):
    orders, lines, customers = (t.table(spark, sf, n) for n in ("orders", "lineitem", "customer"))
    return audit.all_of(
        [
            audit.orphans(lines, "l_orderkey", orders, "o_orderkey", "lineitem"),
            audit.orphans(orders, "o_custkey", customers, "c_custkey", "orders"),
            audit.childless(orders, "o_orderkey", lines, "l_orderkey", "orders"),
            audit.duplicates(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
            audit.failing(lines, "discount", F.col("l_discount") <= 0.09, "l_orderkey", "lineitem"),
            audit.below_minimum(orders, "o_orderpriority", {"1-URGENT": 1, "6-NONE": 1}, "orders"),
        ]
    )


def gene_set_sanity(spark, sf):
    """Customers as genes, orders as transcripts, line items as exons, with some links, places and bounds put wrong."""
    exons = checkpointed(t.exons(spark, sf).drop("score", "identity", "coverage"))
    orders = t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("gene_id"), F.col("o_custkey").alias("locus"))
    own = exons.join(orders, "gene_id")
    genes = own.filter("locus % 50 <> 0").groupBy(F.col("locus").alias("gene_id")).agg(F.min("region").alias("region"), F.min("start").alias("start"), F.max(F.when(F.col("rank") < 7, F.col("end"))).alias("end"))
    place = (F.col("region") + F.when(F.col("gene_id") % 97 == 0, 1).otherwise(0)).alias("region")
    kind = F.when(F.col("biotype") == "1-URGENT", "protein_coding").otherwise(F.col("biotype")).alias("biotype")
    transcripts = own.groupBy(F.col("gene_id").alias("transcript_id"), F.col("locus").alias("_locus"), place, "strand", kind).agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumnRenamed("_locus", "gene_id")
    exon_id = F.concat_ws(".", "gene_id", "rank")
    turned = F.when(F.col("hit") % 61 == 0, -F.col("strand")).otherwise(F.col("strand")).alias("strand")
    rows = exons.filter("hit % 59 <> 0").select(exon_id.alias("exon_id"), "region", turned, (F.col("start") - F.when(F.col("hit") % 71 == 0, 1).otherwise(0)).alias("start"), "end")
    links = exons.filter("hit % 53 <> 0").select(F.col("gene_id").alias("transcript_id"), exon_id.alias("exon_id"))
    ends = exons.filter("source = 'F'").groupBy(F.col("gene_id").alias("transcript_id")).agg(F.min(exon_id).alias("start_exon"), F.max(exon_id).alias("end_exon"))
    return audit.gene_sanity(genes, transcripts, links, rows, ends)


def model_oddities(spark, sf):
    """Models with phases from their hits, ranks that two lines may share, and a peptide where a sequence has their number."""
    phase = (F.col("hit") % 4 - 1).cast("int")
    # ranks in order of transcription: on the reverse strand they run down
    turned = F.when(F.col("strand") == 1, F.col("rank")).otherwise(F.count(F.lit(1)).over(Window.partitionBy("gene_id")).cast("int") + 1 - F.col("rank"))
    lines = t.exons(spark, sf).withColumn("rank", turned - F.when(F.col("hit") % 83 == 0, 1).otherwise(0))
    own = F.when(F.col("hit") % 67 == 0, -F.col("strand")).otherwise(F.col("strand"))
    exon = F.struct("rank", "start", "end", own.alias("strand"), phase.alias("phase"), ((phase + F.col("end") - F.col("start") + 1) % 3).cast("int").alias("end_phase"))
    grouped = lines.groupBy("gene_id", "strand").agg(F.collect_list(exon).alias("exons"), F.count_if(F.col("identity") > 95).alias("evidence"))
    peptides = t.sequences(spark, sf).select(F.col("seq_id").alias("gene_id"), F.regexp_replace(q.translated(F.col("seq")), r"\*$", "").alias("peptide"))
    return audit.model_checks(grouped.join(peptides, "gene_id", "left"), 6, (4, 48), (12, 55), 200)


def chunked_regions(spark, sf):
    tops = t.exons(spark, sf).groupBy("region").agg(F.max("end").alias("length"))
    return factories.windows(tops, 5000, 500)


def padded_genes(spark, sf):
    genes = t.transcripts(spark, sf).select("gene_id", "region", "start", "end")
    tops = genes.groupBy("region").agg(F.max("end").alias("length"))
    return factories.padded(genes.join(tops, "region"), 200, "length").select("gene_id", "region", "start", "end")


def batches_of_genes(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("length", models.total_length("exons"))
    balanced = factories.balanced_batches(genes.select("gene_id", "region", "length"), ["region"], "length", "gene_id", 1000)
    return balanced.groupBy("region", "batch").agg(F.count(F.lit(1)).alias("genes"), F.sum("length").alias("bases"))


def neighbour_gaps(spark, sf):
    genes = t.transcripts(spark, sf).select("gene_id", *STRANDED, "start", "end")
    return factories.neighbours(genes, STRANDED, ["start", "end", "gene_id"]).select("gene_id", "previous_gap", "next_gap")


def junction_depths(spark, sf):
    """Summed depth of equal introns: those read once plus half of the others, rounded up."""
    gaps = t.transcripts(spark, sf).select("gene_id", *STRANDED, F.explode(models.introns(F.col("exons"))).alias("i"))
    reads = t.features(spark, sf).groupBy("gene_id").agg(F.count_if(F.col("flag") == "N").alias("once"), F.count_if(F.col("flag") != "N").alias("many"))
    rows = gaps.join(reads, "gene_id")
    depth = F.col("once") + F.ceil(F.col("many") / 2)
    return rows.groupBy(*STRANDED, F.col("i.start").alias("start"), F.col("i.end").alias("end")).agg(F.sum(depth).cast("long").alias("depth"), F.count(F.lit(1)).alias("models"))


def biotype_rollup(spark, sf):
    genes = t.transcripts(spark, sf)
    return genes.rollup("source", "biotype").agg(F.count(F.lit(1)).alias("genes"), F.grouping_id().cast("long").alias("level"))


def capped_translations(spark, sf):
    genes = t.transcripts(spark, sf).withColumn("length", models.total_length("exons"))
    order = Window.partitionBy(*STRANDED).orderBy(F.desc("length"), "gene_id")
    return genes.withColumn("n", F.row_number().over(order)).filter("n <= 3").select(*STRANDED, "gene_id", "length", F.col("n").cast("int").alias("place"))


QUERIES = {
    f.__name__: f
    for f in (
        intron_facts, intron_chains, split_models, trimmed_models, clipped_models, exon_phases, cdna_positions, exon_pair_support, consensus_scores, shared_exons,
        exon_density, longest_model_per_region, translations, best_frames, composition, reverse_complements, projected_exons, integrity, gene_set_sanity, model_oddities, chunked_regions,
        padded_genes, batches_of_genes, neighbour_gaps, junction_depths, biotype_rollup, capped_translations,
    )
}

_GAPS = """
gaps AS (
  SELECT gene_id, region, strand, rank, "start", "end", "end" + 1 AS i_start, lead("start") OVER (PARTITION BY gene_id ORDER BY "start", rank) - 1 AS i_end FROM exons
), introns AS (SELECT gene_id, region, strand, rank, i_start, i_end, i_end - i_start + 1 AS len FROM gaps WHERE i_end IS NOT NULL)"""
_M = f"WITH {t.EXONS}, {t.TRANSCRIPTS}"


def _peptide(frame):
    # codons of one frame by position, then letters by the standard code
    return f"""
SELECT seq_id, {frame} AS frame, string_agg(substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG',
    16 * (instr('TCAG', substr(seq, i, 1)) - 1) + 4 * (instr('TCAG', substr(seq, i + 1, 1)) - 1) + instr('TCAG', substr(seq, i + 2, 1)), 1), '' ORDER BY i) AS peptide
FROM (SELECT seq_id, seq, unnest(range(1 + {frame}, length(seq) - 1, 3)) AS i FROM sequences) GROUP BY 1"""


ORACLE_SQL = {
    "intron_facts": f"""{_M}, {_GAPS}
SELECT gene_id, count(len) AS n_introns, coalesce(sum(len), 0)::BIGINT AS intron_length, any_value(exon_length) AS exon_length, max(len) AS longest, coalesce(bool_or(len < 15), false) AS has_short
FROM transcripts LEFT JOIN introns USING (gene_id) GROUP BY 1""",
    "intron_chains": f"""{_M}, {_GAPS}, chains AS (
  SELECT gene_id, region, strand, string_agg(i_start::VARCHAR || ':' || i_end::VARCHAR, ':' ORDER BY i_start) AS chain FROM introns GROUP BY 1, 2, 3)
SELECT region, strand, chain, count(*) AS genes, min(gene_id) AS first_gene FROM chains GROUP BY 1, 2, 3""",
    "split_models": f"""{_M}, cuts AS (
  SELECT *, CASE WHEN "start" - lag("end") OVER w - 1 > 45 THEN 1 ELSE 0 END AS cut FROM exons WINDOW w AS (PARTITION BY gene_id ORDER BY "start", rank)), parts AS (
  SELECT *, (sum(cut) OVER (PARTITION BY gene_id ORDER BY "start", rank ROWS UNBOUNDED PRECEDING) + 1)::BIGINT AS part FROM cuts)
SELECT gene_id, part, count(*) AS n_exons, min("start") AS "start", max("end") AS "end" FROM parts GROUP BY 1, 2""",
    "trimmed_models": f"""{_M}, ends AS (SELECT gene_id, min(rank) AS a, max(rank) AS b FROM exons WHERE "end" - "start" + 1 >= 15 GROUP BY 1)
SELECT gene_id, count(*) AS n_exons, min("start") AS "start", max("end") AS "end" FROM exons JOIN ends USING (gene_id) WHERE rank BETWEEN a AND b GROUP BY 1""",
    "clipped_models": f"""{_M}
SELECT e.gene_id AS gene_id, count(*) AS n_exons, sum(least(e."end", t."end" - 10) - greatest(e."start", t."start" + 10) + 1)::BIGINT AS cds_length
FROM exons e JOIN transcripts t ON e.gene_id = t.gene_id WHERE e."start" <= t."end" - 10 AND e."end" >= t."start" + 10 GROUP BY 1""",
    "exon_phases": f"""{_M}, run AS (SELECT gene_id, rank, "end" - "start" + 1 AS len, coalesce(sum("end" - "start" + 1) OVER (PARTITION BY gene_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM exons)
SELECT gene_id, rank, (before % 3)::INTEGER AS phase, ((before % 3 + len) % 3)::INTEGER AS end_phase FROM run""",
    "cdna_positions": f"""{_M}, run AS (SELECT gene_id, rank, "end" - "start" + 1 AS len, coalesce(sum("end" - "start" + 1) OVER (PARTITION BY gene_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM exons)
SELECT gene_id, rank, (before + 1)::BIGINT AS cdna_start, (before + len)::BIGINT AS cdna_end FROM run""",
    "exon_pair_support": f"""{_M}, pairs AS (
  SELECT gene_id, region, strand, "end" - "start" + 1 AS len, lead("start") OVER w - "end" - 1 AS gap, lead("end") OVER w - lead("start") OVER w + 1 AS next FROM exons WINDOW w AS (PARTITION BY gene_id ORDER BY "start", rank)
), shared AS (SELECT region, strand, gap, len, next, count(DISTINCT gene_id) AS genes FROM pairs WHERE gap IS NOT NULL GROUP BY ALL)
SELECT gene_id, count(*) AS pairs, min(genes) AS support, min(genes) >= 2 AS stays FROM pairs JOIN shared USING (region, strand, gap, len, next) GROUP BY 1""",
    "consensus_scores": f"""{_M}, same AS (SELECT region, strand, "start", "end", count(DISTINCT gene_id) AS n_same FROM exons GROUP BY 1, 2, 3, 4), over AS (
  SELECT a.gene_id AS gene_id, a.rank AS rank, count(DISTINCT b.gene_id) AS n_over FROM exons a JOIN exons b ON a.region = b.region AND a.strand = b.strand AND a."start" <= b."end" AND a."end" >= b."start" GROUP BY 1, 2)
SELECT gene_id, rank, n_same, n_over, round(n_same / n_over, 6) AS quotient FROM exons JOIN same USING (region, strand, "start", "end") JOIN over USING (gene_id, rank)""",
    "shared_exons": f"""{_M}
SELECT concat_ws(':', region, strand, "start", "end") AS exon_key, count(*) AS uses, count(DISTINCT gene_id) AS genes FROM exons GROUP BY 1 HAVING count(DISTINCT gene_id) > 1""",
    "exon_density": f"""{_M} SELECT biotype, round(avg(100 * exon_length / ("end" - "start" + 1)), 6) AS density, max(n_exons) AS most_exons FROM transcripts GROUP BY 1""",
    "longest_model_per_region": f"""{_M} SELECT region, strand, gene_id, exon_length AS length FROM transcripts QUALIFY row_number() OVER (PARTITION BY region, strand ORDER BY exon_length DESC, gene_id) = 1""",
    "translations": f"""WITH {t.SEQUENCES}, peptides AS ({_peptide(0)})
SELECT seq_id, coalesce(length(peptide), 0)::BIGINT AS residues, (coalesce(length(peptide), 0) - length(replace(coalesce(peptide, ''), '*', '')))::BIGINT AS stops, md5(coalesce(peptide, '')) AS peptide_md5
FROM sequences LEFT JOIN peptides USING (seq_id)""",
    "best_frames": f"""WITH {t.SEQUENCES}, turned AS (SELECT seq_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq FROM sequences), peptides AS ({" UNION ALL ".join([_peptide(i) for i in range(3)] + [_peptide(i).replace("FROM sequences", "FROM turned").replace(f"{i} AS frame", f"{i + 3} AS frame") for i in range(3)])}), pieces AS (
  SELECT seq_id, frame, unnest(string_split(peptide, '*')) AS piece FROM peptides)
SELECT seq_id, frame, max(length(piece) - instr(piece, 'M') + 1)::BIGINT AS longest, count(*) AS frames FROM pieces WHERE contains(piece, 'M') GROUP BY 1, 2""",
    "composition": f"""WITH {t.SEQUENCES}, counts AS (
  SELECT seq_id, seq, length(seq) AS n, {', '.join(f"(length(seq) - length(replace(seq, '{b}', '')))::BIGINT AS {b.lower()}" for b in 'ACGT')} FROM sequences)
SELECT seq_id, a, c, g, t, CASE WHEN n > 0 THEN round(100 * ((g + c) / n), 4) END AS gc, length(regexp_extract(seq, '(A*)$', 1))::BIGINT AS tail,
  contains(substr(seq, greatest(n - 30 + 1, 1), 20), 'AATA') AS signal FROM counts""",
    "reverse_complements": f"""WITH {t.SEQUENCES} SELECT seq_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc_md5 FROM sequences""",
    "projected_exons": f"""WITH {t.EXONS}, {t.FEATURES}, blocks AS (
  SELECT region, 20 * "start" + 1 AS b, 20 * "start" + 200 AS e, hit AS target, CASE WHEN hit % 2 = 0 THEN 1 ELSE -1 END AS orientation FROM features WHERE flag = 'A'
), pieces AS (
  SELECT gene_id, greatest("start", b) AS lo, least("end", e) AS hi, b, e, orientation FROM exons x JOIN blocks k ON x.region = k.region AND x."start" <= e AND x."end" >= b
), placed AS (SELECT gene_id, hi - lo AS span, CASE WHEN orientation = 1 THEN 1 + lo - b ELSE 1 + e - hi END AS low FROM pieces)
SELECT gene_id, count(*) AS pieces, sum(span + 1)::BIGINT AS bases, min(low) AS low, max(low + span) AS high FROM placed GROUP BY 1""",
    "gene_set_sanity": f"""WITH {t.EXONS}, own AS (SELECT exons.*, o_custkey AS locus FROM exons JOIN orders ON o_orderkey = gene_id),
g AS (SELECT locus AS id, min(region) AS region, min("start") AS s, max(CASE WHEN rank < 7 THEN "end" END) AS e FROM own WHERE locus % 50 <> 0 GROUP BY 1),
t AS (SELECT gene_id AS id, locus, region + CASE WHEN gene_id % 97 = 0 THEN 1 ELSE 0 END AS region, strand, biotype = '1-URGENT' AS coding, min("start") AS s, max("end") AS e FROM own GROUP BY 1, 2, 3, 4, 5),
every AS (SELECT gene_id, gene_id || '.' || rank AS id, region, strand * CASE WHEN hit % 61 = 0 THEN -1 ELSE 1 END AS strand, "start" - CASE WHEN hit % 71 = 0 THEN 1 ELSE 0 END AS s, "end" AS e, hit, source FROM exons),
x AS (SELECT * FROM every WHERE hit % 59 <> 0), l AS (SELECT gene_id AS tid, id AS xid FROM every WHERE hit % 53 <> 0),
p AS (SELECT gene_id AS tid, min(id) AS a, max(id) AS b FROM every WHERE source = 'F' GROUP BY 1),
b AS (SELECT g.id AS id, any_value(g.s) AS s, any_value(g.e) AS e, min(t.s) AS low, max(t.e) AS high FROM g JOIN t ON t.locus = g.id GROUP BY 1),
lx AS (SELECT tid, xid, x.region AS region, x.strand AS strand, x.s AS s, x.e AS e, t.region AS tr, t.strand AS ts, t.s AS tb, t.e AS te FROM l JOIN x ON x.id = xid JOIN t ON t.id = tid)
SELECT 'childless' AS rule, 'gene' AS table_name, id::VARCHAR AS key, '0' AS found FROM g WHERE id NOT IN (SELECT locus FROM t)
UNION ALL SELECT 'orphan', 'transcript', locus::VARCHAR, locus::VARCHAR FROM t WHERE locus NOT IN (SELECT id FROM g)
UNION ALL SELECT 'region', 'gene', g.id || ':' || t.id, t.region::VARCHAR FROM g JOIN t ON t.locus = g.id WHERE g.region <> t.region
UNION ALL SELECT 'bounds', 'gene', id::VARCHAR, low || ':' || high FROM b WHERE s <> low OR e <> high
UNION ALL SELECT 'childless', 'transcript', id::VARCHAR, '0' FROM t WHERE id NOT IN (SELECT tid FROM l)
UNION ALL SELECT 'orphan', 'link', xid, xid FROM l WHERE xid NOT IN (SELECT id FROM x)
UNION ALL SELECT 'orphan', 'translation', tid::VARCHAR, tid::VARCHAR FROM p WHERE tid NOT IN (SELECT id FROM t)
UNION ALL SELECT 'childless', 'coding_transcript', id::VARCHAR, '0' FROM t WHERE coding AND id NOT IN (SELECT tid FROM p)
UNION ALL SELECT 'start_exon', 'translation', tid::VARCHAR, a FROM p WHERE tid || '/' || a NOT IN (SELECT tid || '/' || xid FROM l)
UNION ALL SELECT 'end_exon', 'translation', tid::VARCHAR, b FROM p WHERE tid || '/' || b NOT IN (SELECT tid || '/' || xid FROM l)
UNION ALL SELECT 'region', 'exon', tid || ':' || xid, region::VARCHAR FROM lx WHERE region <> tr
UNION ALL SELECT 'strand', 'exon', tid || ':' || xid, strand::VARCHAR FROM lx WHERE strand <> ts
UNION ALL SELECT 'outside', 'exon', tid || ':' || xid, s || ':' || e FROM lx WHERE s < tb OR e > te""",
    "model_oddities": f"""WITH {t.EXONS}, {t.SEQUENCES}, peptides AS ({_peptide(0)}), numbered AS (
  SELECT gene_id, strand, "start" AS s, "end" AS e, identity, CASE WHEN strand = 1 THEN rank ELSE count(*) OVER (PARTITION BY gene_id) + 1 - rank END - CASE WHEN hit % 83 = 0 THEN 1 ELSE 0 END AS r,
    CASE WHEN hit % 67 = 0 THEN -strand ELSE strand END AS own, hit % 4 - 1 AS ph, (hit % 4 - 1 + "end" - "start" + 1) % 3 AS ep FROM exons
), paired AS (
  SELECT *, lead(s) OVER w AS ns, lead(e) OVER w AS ne, lead(ph) OVER w AS nph, row_number() OVER w AS k FROM numbered WINDOW w AS (PARTITION BY gene_id ORDER BY r, s, e, own, ph, ep)
), facts AS (
  SELECT gene_id, count(*) AS n, count(*) FILTER (r <> k) AS ranks, count(*) FILTER (own <> strand) AS mixed, count(*) FILTER (ns IS NOT NULL AND CASE WHEN strand = 1 THEN ns <= s ELSE s <= ns END) AS disorder,
    count(*) FILTER (s <= ne AND ns <= e) AS overlap, count(*) FILTER (e - s + 1 < 4) AS short, count(*) FILTER (e - s + 1 > 48) AS long,
    count(*) FILTER (gap >= 1 AND gap < 12) AS si, count(*) FILTER (gap > 55) AS li, count(*) FILTER (nph IS NOT NULL AND ep <> nph) AS phase,
    count(*) FILTER (ph >= 0 AND ep >= 0 AND (ph + e - s + 1) % 3 <> ep) AS endphase, count(*) FILTER (identity > 95) AS evidence
  FROM (SELECT *, CASE WHEN strand = 1 THEN ns - e - 1 ELSE s - ne - 1 END AS gap FROM paired) GROUP BY 1
), joined AS (SELECT facts.*, CASE WHEN seq_id IS NOT NULL THEN regexp_replace(coalesce(peptide, ''), '\\*$', '') END AS pep FROM facts LEFT JOIN sequences ON seq_id = gene_id LEFT JOIN peptides USING (seq_id)),
rules AS (
  SELECT gene_id, 'numexons' AS rule, CASE WHEN n > 6 THEN n ELSE 0 END AS found FROM joined UNION ALL SELECT gene_id, 'ranks', CASE WHEN ranks > 0 THEN n ELSE 0 END FROM joined
  UNION ALL SELECT gene_id, 'mixedstrands', mixed FROM joined UNION ALL SELECT gene_id, 'order', disorder FROM joined UNION ALL SELECT gene_id, 'overlap', overlap FROM joined
  UNION ALL SELECT gene_id, 'shortexon', short FROM joined UNION ALL SELECT gene_id, 'longexon', long FROM joined UNION ALL SELECT gene_id, 'shortintron', si FROM joined UNION ALL SELECT gene_id, 'longintron', li FROM joined
  UNION ALL SELECT gene_id, 'phase', phase FROM joined UNION ALL SELECT gene_id, 'endphase', endphase FROM joined UNION ALL SELECT gene_id, 'nosupport', CASE WHEN evidence = 0 THEN 1 ELSE 0 END FROM joined
  UNION ALL SELECT gene_id, 'zerolen', CASE WHEN pep = '' THEN 1 ELSE 0 END FROM joined UNION ALL SELECT gene_id, 'allx', CASE WHEN regexp_matches(pep, '^X+$') THEN length(pep) ELSE 0 END FROM joined
  UNION ALL SELECT gene_id, 'stops', length(pep) - length(replace(pep, '*', '')) FROM joined UNION ALL SELECT gene_id, 'shortpeptide', CASE WHEN pep <> '' AND length(pep) < 200 THEN length(pep) ELSE 0 END FROM joined)
SELECT gene_id, rule, found::BIGINT AS found FROM rules WHERE found > 0""",
    "integrity": """
SELECT 'orphan' AS rule, 'lineitem' AS table_name, l_orderkey::VARCHAR AS key, l_orderkey::VARCHAR AS found FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orphan', 'orders', o_custkey::VARCHAR, o_custkey::VARCHAR FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'childless', 'orders', o_orderkey::VARCHAR, '0' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'duplicate', 'lineitem', l_orderkey || ':' || l_linenumber, count(*)::VARCHAR FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'discount', 'lineitem', l_orderkey::VARCHAR, 'false' FROM lineitem WHERE NOT l_discount <= 0.09
UNION ALL SELECT 'below_minimum', 'orders', p, n::VARCHAR FROM (SELECT p, (SELECT count(*) FROM orders WHERE o_orderpriority = p) AS n FROM (VALUES ('1-URGENT'), ('6-NONE')) v(p)) WHERE n < 1""",
    "chunked_regions": f"""WITH {t.EXONS}, tops AS (SELECT region, max("end") AS length FROM exons GROUP BY 1)
SELECT region, s AS "start", least(s + 4999, length) AS "end" FROM (SELECT region, length, unnest(range(1, greatest(length - 500, 1) + 1, 4500)) AS s FROM tops)""",
    "padded_genes": f"""{_M}, tops AS (SELECT region, max("end") AS length FROM transcripts GROUP BY 1)
SELECT gene_id, region, greatest("start" - 200, 1) AS "start", least("end" + 200, length) AS "end" FROM transcripts JOIN tops USING (region)""",
    "batches_of_genes": f"""{_M}, run AS (SELECT region, exon_length, floor(coalesce(sum(exon_length) OVER (PARTITION BY region ORDER BY exon_length, gene_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 1000)::BIGINT AS batch FROM transcripts)
SELECT region, batch, count(*) AS genes, sum(exon_length)::BIGINT AS bases FROM run GROUP BY 1, 2""",
    "neighbour_gaps": f"""{_M}
SELECT gene_id, "start" - lag("end") OVER w - 1 AS previous_gap, lead("start") OVER w - "end" - 1 AS next_gap FROM transcripts WINDOW w AS (PARTITION BY region, strand ORDER BY "start", "end", gene_id)""",
    "junction_depths": f"""WITH {t.EXONS}, {t.FEATURES}, {_GAPS}, reads AS (SELECT gene_id, count(*) FILTER (flag = 'N') AS once, count(*) FILTER (flag <> 'N') AS many FROM features GROUP BY 1)
SELECT region, strand, i_start AS "start", i_end AS "end", sum(once + ceil(many / 2))::BIGINT AS depth, count(*) AS models FROM introns JOIN reads USING (gene_id) GROUP BY 1, 2, 3, 4""",
    "biotype_rollup": f"""{_M} SELECT source, biotype, count(*) AS genes, grouping_id(source, biotype)::BIGINT AS level FROM transcripts GROUP BY ROLLUP (source, biotype)""",
    "capped_translations": f"""{_M}, ranked AS (SELECT region, strand, gene_id, exon_length AS length, row_number() OVER (PARTITION BY region, strand ORDER BY exon_length DESC, gene_id)::INTEGER AS place FROM transcripts)
SELECT * FROM ranked WHERE place <= 3""",
}
