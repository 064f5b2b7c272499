"""Integrity checks. Each gives rows of one shape: rule, table, key, found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import checkpointed


def _violation(rows: DataFrame, rule: str, table: str, key: Column, found: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), key.cast("string").alias("key"), found.cast("string").alias("found"))


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str, table: str) -> DataFrame:
    """Children whose key is no parent's."""
    lost = child.join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")
    return _violation(lost, "orphan", table, F.col(foreign), F.col(foreign))


def childless(parent: DataFrame, key: str, child: DataFrame, foreign: str, table: str) -> DataFrame:
    lost = parent.join(child.select(F.col(foreign).alias(key)), key, "left_anti")
    return _violation(lost, "childless", table, F.col(key), F.lit("0"))


def duplicates(rows: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _violation(counts, "duplicate", table, F.concat_ws(":", *key), F.col("n"))


def failing(rows: DataFrame, rule: str, condition: Column, key: str, table: str) -> DataFrame:
    """Rows for which the condition does not hold; null counts as failing."""
    return _violation(rows.filter(~F.coalesce(condition, F.lit(False))), rule, table, F.col(key), F.lit("false"))


def below_minimum(rows: DataFrame, by: str, minimum: Mapping[str, int], table: str) -> DataFrame:
    """Groups with fewer rows than asked, those without rows too."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame(list(minimum.items()), f"`{by}` string, least long")
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    short = wanted.join(counts, by, "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < least")
    return _violation(short, "below_minimum", table, F.col(by), F.col("n"))


def all_of(checks: Sequence[DataFrame]) -> DataFrame:
    result = checks[0]
    for more in checks[1:]:
        result = result.unionByName(more)
    return result


def gene_sanity(genes: DataFrame, transcripts: DataFrame, links: DataFrame, exons: DataFrame, translations: DataFrame, coding: str = "protein_coding") -> DataFrame:
    """Violations of what a gene set's tables must hold, each rule a join that should give no row.

    genes: gene_id, region, start, end; transcripts: transcript_id, gene_id, region, strand, start, end, biotype; links:
    transcript_id, exon_id; exons: exon_id, region, strand, start, end; translations: transcript_id, start_exon, end_exon.
    Rules: a gene has a transcript, on its region and with its bounds in all; a transcript has exons and a link has both of
    its sides; a translation has its transcript, a coding transcript its translation, and both of its exons are linked to
    that transcript; exons lie on their transcript's region, strand and within its bounds."""
    genes, transcripts = checkpointed(genes), checkpointed(transcripts)
    place = transcripts.select("transcript_id", F.col("gene_id"), F.col("region").alias("t_region"), F.col("strand").alias("t_strand"), F.col("start").alias("t_start"), F.col("end").alias("t_end"))
    of_gene = genes.join(place, "gene_id")
    bounds = of_gene.groupBy("gene_id", "start", "end").agg(F.min("t_start").alias("low"), F.max("t_end").alias("high"))
    linked = links.join(exons, "exon_id").join(place, "transcript_id")
    key = lambda *names: F.concat_ws(":", *names)
    ends = translations.select("transcript_id", F.explode(F.array(F.struct(F.lit("start_exon").alias("rule"), F.col("start_exon").alias("exon_id")), F.struct(F.lit("end_exon").alias("rule"), F.col("end_exon").alias("exon_id")))).alias("e")).select("transcript_id", "e.*")
    # one pass over the linked exons for all that may be wrong with their place
    wrong = {
        "region": (F.col("region") != F.col("t_region"), F.col("region").cast("string")),
        "strand": (F.col("strand") != F.col("t_strand"), F.col("strand").cast("string")),
        "outside": ((F.col("start") < F.col("t_start")) | (F.col("end") > F.col("t_end")), key("start", "end")),
    }
    marks = F.array(*[F.when(where, F.struct(F.lit(rule).alias("rule"), found.alias("found"))) for rule, (where, found) in wrong.items()])
    misplaced = linked.select("transcript_id", "exon_id", F.explode(F.array_compact(marks)).alias("v"))
    unlinked = ends.join(links, ["transcript_id", "exon_id"], "left_anti")
    out = [
        childless(genes, "gene_id", transcripts, "gene_id", "gene"),
        orphans(transcripts, "gene_id", genes, "gene_id", "transcript"),
        _violation(of_gene.filter("region <> t_region"), "region", "gene", key("gene_id", "transcript_id"), F.col("t_region")),
        _violation(bounds.filter("start <> low OR end <> high"), "bounds", "gene", F.col("gene_id"), key("low", "high")),
        childless(transcripts, "transcript_id", links, "transcript_id", "transcript"),
        orphans(links, "exon_id", exons, "exon_id", "link"),
        orphans(links, "transcript_id", transcripts, "transcript_id", "link"),
        orphans(translations, "transcript_id", transcripts, "transcript_id", "translation"),
        childless(transcripts.filter(F.col("biotype") == coding), "transcript_id", translations, "transcript_id", "coding_transcript"),
        unlinked.select("rule", F.lit("translation").alias("table_name"), F.col("transcript_id").cast("string").alias("key"), F.col("exon_id").cast("string").alias("found")),
        misplaced.select("v.rule", F.lit("exon").alias("table_name"), key("transcript_id", "exon_id").alias("key"), "v.found"),
    ]
    return all_of(out)


def model_checks(models: DataFrame, most_exons: int, exon_sizes: tuple[int, int], intron_sizes: tuple[int, int], shortest_peptide: int) -> DataFrame:
    """gene_id, rule, found: what is odd about single models. models: gene_id, strand, exons (rank, start, end, strand, phase,
    end_phase; any order), peptide (null without translation; a stop at its end is left out), evidence (pieces of it).

    Rules: noexons, numexons (over most_exons), ranks (not 1 to n in order of transcription), mixedstrands, order (an exon
    begins before or with the one before it in genomic order of ranks, so they are double or nested), overlap, shortexon,
    longexon, shortintron, longintron (introns of one base and more), phase (an exon's differs from the end phase before
    it), endphase (it is not what length and phase make it, where both are set), nosupport; and of a peptide: zerolen,
    allx, stops, shortpeptide."""
    e = F.col("exons")
    ahead = F.col("strand") == 1
    ordered = F.array_sort(e)  # by rank
    n = F.size(e)
    pairs = F.zip_with(F.slice(ordered, 1, F.greatest(n - 1, F.lit(0))), F.slice(ordered, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    low = lambda p: F.when(ahead, p["a"]).otherwise(p["b"])
    high = lambda p: F.when(ahead, p["b"]).otherwise(p["a"])
    gaps = F.transform(F.filter(pairs, lambda p: high(p)["start"] > low(p)["end"] + 1), lambda p: high(p)["start"] - low(p)["end"] - 1)
    lengths = F.transform(e, lambda x: x["end"] - x["start"] + 1)
    count = lambda c, f: F.size(F.filter(c, f)).cast("long")
    pep = F.col("peptide")
    rules = {
        "noexons": F.when(n == 0, F.lit(1)),
        "numexons": F.when(n > most_exons, n),
        "ranks": F.when((n > 0) & (F.transform(ordered, lambda x: x["rank"].cast("int")) != F.sequence(F.lit(1), F.greatest(n, F.lit(1)))), n),
        "mixedstrands": F.nullif(count(e, lambda x: x["strand"] != F.col("strand")), F.lit(0)),
        "order": F.nullif(count(pairs, lambda p: high(p)["start"] <= low(p)["start"]), F.lit(0)),
        "overlap": F.nullif(count(pairs, lambda p: (p["a"]["start"] <= p["b"]["end"]) & (p["b"]["start"] <= p["a"]["end"])), F.lit(0)),
        "shortexon": F.nullif(count(lengths, lambda x: x < exon_sizes[0]), F.lit(0)),
        "longexon": F.nullif(count(lengths, lambda x: x > exon_sizes[1]), F.lit(0)),
        "shortintron": F.nullif(count(gaps, lambda x: x < intron_sizes[0]), F.lit(0)),
        "longintron": F.nullif(count(gaps, lambda x: x > intron_sizes[1]), F.lit(0)),
        "phase": F.nullif(count(pairs, lambda p: p["a"]["end_phase"] != p["b"]["phase"]), F.lit(0)),
        "endphase": F.nullif(count(e, lambda x: (x["phase"] >= 0) & (x["end_phase"] >= 0) & ((x["phase"] + x["end"] - x["start"] + 1) % 3 != x["end_phase"])), F.lit(0)),
        "nosupport": F.when(F.coalesce("evidence", F.lit(0)) == 0, F.lit(1)),
        "zerolen": F.when(pep == "", F.lit(1)),
        "allx": F.when(pep.rlike("^X+$"), F.length(pep)),
        "stops": F.nullif(F.length(pep) - F.length(F.replace(pep, F.lit("*"), F.lit(""))), F.lit(0)),
        "shortpeptide": F.when((pep != "") & (F.length(pep) < shortest_peptide), F.length(pep)),
    }
    found = F.array(*[F.when(c.isNotNull(), F.struct(F.lit(name).alias("rule"), c.cast("long").alias("found"))) for name, c in rules.items()])
    return models.select("gene_id", F.explode(F.array_compact(found)).alias("v")).select("gene_id", "v.*")
