"""Readers and writers of annotation text formats, as Spark scans with fixed schemas.

Line formats split by byte ranges like any text file. Formats whose record spans lines are read with a record separator,
so that a record is never cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import open_frames, reverse_complement, translated

GTF = "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
JUNCTION = "region string, start long, end long, strand int, canonical int, annotated int, unique_count int, multi_count int"
DEPTH = "region string, pos long, depth int"
BLAST = "query string, subject string, identity double, length long, mismatches int, gap_opens int, q_start long, q_end long, s_start long, s_end long, evalue double, bits double"
AGP = "object string, object_start long, object_end long, part int, kind string, component string, component_start string, component_end string, orientation string"


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a tabular file; a line that does not fit the schema is an error, never a loss."""
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").option("quote", "").option("mode", "FAILFAST").csv(path)


def gtf_attribute(name: str, attributes: str = "attributes") -> Column:
    """Value of key "value"; in the ninth column, null if it is absent."""
    found = F.regexp_extract(F.col(attributes), rf'(?:^|;)\s*{name} "([^"]*)"', 1)
    return F.when(found != "", found)


def gff_attribute(name: str, attributes: str = "attributes") -> Column:
    found = F.regexp_extract(F.col(attributes), rf"(?:^|;){name}=([^;]*)", 1)
    return F.when(found != "", F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    rows = _tsv(spark, path, GTF)
    return rows.withColumns({"gene_id": gtf_attribute("gene_id"), "transcript_id": gtf_attribute("transcript_id"), "strand": F.when(F.col("strand") == "-", -1).otherwise(1)})


def gtf_models(rows: DataFrame) -> DataFrame:
    """One row for each transcript of a GTF: its extent and its exons in order of transcription."""
    exons = rows.filter("feature = 'exon'").groupBy("gene_id", "transcript_id", "seqname", "strand")
    own = F.array_sort(F.collect_list(F.struct(F.col("strand") * F.col("start"), "start", "end")))
    found = exons.agg(F.min("start").alias("start"), F.max("end").alias("end"), own.alias("exons"))
    ranked = F.transform("exons", lambda e, i: F.struct((i + 1).alias("rank"), e["start"].alias("start"), e["end"].alias("end")))
    return found.withColumn("exons", ranked)


def _coding(rows: DataFrame, key: str) -> DataFrame:
    """key, cds_start, cds_end, phase: the span of CDS and stop codon rows, and the phase of the first CDS row in order of
    transcription (null where it is a dot)."""
    own = rows.filter(F.col("feature").isin("CDS", "stop_codon"))
    phase = F.when(F.col("frame").rlike("^[0-2]$"), F.col("frame")).cast("int")
    first = F.min_by(phase, F.when(F.col("feature") == "CDS", F.col("strand") * F.when(F.col("strand") == 1, F.col("start")).otherwise(F.col("end"))))
    return own.groupBy(key).agg(F.min("start").alias("cds_start"), F.max("end").alias("cds_end"), first.alias("phase"))


def gtf_coding_models(rows: DataFrame, sequences: DataFrame, least: int = 1) -> DataFrame:
    """gtf_models with cds_start, cds_end, phase and how coding was found: given by CDS rows, or, without any, chosen as the
    longest open frame from an M of the spliced sequence on the model's strand (of equals the first; at least so many
    residues). sequences: seqname, seq. Models without either have null. A frame that runs off the end is open; a stop
    belongs to the coding span."""
    models = gtf_models(rows).join(_coding(rows, "transcript_id"), "transcript_id", "left")
    given, bare = models.filter("cds_start IS NOT NULL"), models.filter("cds_start IS NULL")
    spliced = F.array_join(F.transform(F.array_sort(F.transform("exons", lambda e: F.struct(e["start"], e["end"]))), lambda e: F.substr("seq", e["start"].cast("int"), (e["end"] - e["start"] + 1).cast("int"))), "")
    read = F.when(F.col("strand") == 1, F.col("_plus")).otherwise(reverse_complement(F.col("_plus")))
    based = bare.join(sequences, "seqname").withColumn("_plus", spliced).withColumn("_seq", read)
    frames = based.select("transcript_id", F.posexplode(F.array(*[translated(F.col("_seq"), f) for f in range(3)])).alias("frame", "peptide"))
    pieces = frames.select("transcript_id", "frame", F.explode(open_frames(F.col("peptide"))).alias("o"), "peptide")
    ended = F.substr("peptide", F.col("o.start") + F.col("o.length") + 1, F.lit(1)) == "*"
    at = pieces.filter(F.col("o.length") >= least).select(
        "transcript_id", F.col("o.length").alias("length"), (3 * F.col("o.start") + F.col("frame") + 1).alias("first"), (3 * (F.col("o.start") + F.col("o.length") + ended.cast("int")) + F.col("frame")).alias("last")
    )
    best = at.groupBy("transcript_id").agg(F.max_by(F.struct("first", "last"), F.struct("length", -F.col("first"))).alias("b"))
    # places in the spliced sequence back to the genome, through the exons in order of transcription
    rows_of = bare.join(best, "transcript_id").select("transcript_id", "strand", "b", F.explode("exons").alias("e")).select("transcript_id", "strand", "b", "e.*")
    through = Window.partitionBy("transcript_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows_of.withColumn("_before", F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(through), F.lit(0)))
    inside = lambda p: (F.col(p) > F.col("_before")) & (F.col(p) <= F.col("_before") + F.col("end") - F.col("start") + 1)
    back = lambda p: F.when(F.col("strand") == 1, F.col("start") + F.col(p) - F.col("_before") - 1).otherwise(F.col("end") - F.col(p) + F.col("_before") + 1)
    ends = placed.groupBy("transcript_id").agg(F.max(F.when(inside("b.first"), back("b.first"))).alias("_a"), F.max(F.when(inside("b.last"), back("b.last"))).alias("_b"))
    chosen = bare.drop("cds_start", "cds_end", "phase").join(ends, "transcript_id", "left").withColumns({"cds_start": F.least("_a", "_b"), "cds_end": F.greatest("_a", "_b"), "phase": F.when(F.col("_a").isNotNull(), 0)}).drop("_a", "_b")
    names = given.columns
    how = F.when(F.col("cds_start").isNotNull(), F.lit("chosen"))
    return given.withColumn("coding", F.lit("given")).unionByName(chosen.select(*names, how.alias("coding")))


def gff3_coding(rows: DataFrame) -> DataFrame:
    """parent (the transcript), cds_start, cds_end, phase of GFF3 rows; a CDS row of several parents counts for each."""
    return _coding(rows.withColumn("parent", F.explode(F.split("parent", ","))), "parent")


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    rows = _tsv(spark, path, GTF)
    return rows.withColumns({"id": gff_attribute("ID"), "parent": gff_attribute("Parent"), "name": gff_attribute("Name"), "strand": F.when(F.col("strand") == "-", -1).otherwise(1)})


def gff3_hierarchy(rows: DataFrame) -> DataFrame:
    """gene, transcript, exon rows of a GFF3 through its Parent links."""
    parents = rows.select("id", F.explode(F.split("parent", ",")).alias("parent"), "feature", "start", "end")
    genes = rows.filter(F.col("parent").isNull()).select(F.col("id").alias("gene_id"))
    transcripts = parents.filter("feature <> 'exon'").select(F.col("id").alias("transcript_id"), F.col("parent").alias("gene_id"))
    exons = parents.filter("feature = 'exon'").select(F.col("parent").alias("transcript_id"), "start", "end")
    return genes.join(transcripts, "gene_id").join(exons, "transcript_id").select("gene_id", "transcript_id", "start", "end")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, seq: the file is cut at its '>' lines, so a sequence stays whole."""
    records = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(text, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(text, r"^[^\r\n]*", ""), r"\s", "")
    found = records.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), body.alias("seq"))
    return found.filter("id <> ''")


def write_fasta(rows: DataFrame, path: str, seq_id: str = "id", seq: str = "seq", width: int = 60) -> None:
    wrapped = F.trim(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n"))
    rows.select(F.concat(F.lit(">"), F.col(seq_id), F.lit("\n"), wrapped)).write.text(path)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, quality: four lines a record, by their number in the file, so a quality may begin with @. A file is one
    range of line numbers; a line that does not fit its place is an error."""
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part")]
    lines = spark.read.text(path).select(*where, F.monotonically_increasing_id().alias("at"), "value")
    # lines of a part have consecutive ids; only the parts' counts are summed along a file
    sizes = lines.groupBy("file", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(sizes.select("file", "part", "low", before.alias("before")), ["file", "part"])
    numbered = placed.withColumn("line", F.col("before") + F.col("at") - F.col("low"))
    record = numbered.groupBy("file", F.floor(F.col("line") / 4).alias("record")).agg(
        *[F.max(F.when(F.col("line") % 4 == i, F.regexp_replace("value", r"\s+$", ""))).alias(name) for i, name in enumerate(("head", "seq", "plus", "quality"))]
    )
    kept = record.filter(F.length(F.concat_ws("", "head", "seq", "plus", "quality")) > 0)
    good = F.startswith("head", F.lit("@")) & F.startswith("plus", F.lit("+")) & (F.length("seq") == F.length("quality"))
    checked = kept.withColumn("id", F.when(F.coalesce(good, F.lit(False)), F.regexp_extract("head", r"^@(\S+)", 1)).otherwise(F.raise_error(F.concat(F.lit("not a FASTQ record: "), F.coalesce("head", F.lit(""))))))
    return checked.select("id", "seq", "quality")


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, JUNCTION)


def junction_depth(rows: DataFrame) -> DataFrame:
    """Depth of each junction: reads that map once and half of the others, rounded up."""
    depth = F.sum(F.col("unique_count") + F.ceil(F.col("multi_count") / 2))
    return rows.groupBy("region", "start", "end", "strand", "canonical").agg(depth.cast("long").alias("depth"))


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, DEPTH)


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, BLAST)


def read_agp(spark: SparkSession, path: str) -> DataFrame:
    """Assembly rows of an AGP: gap lines (N, U) left out."""
    rows = _tsv(spark, path, AGP).filter(~F.col("kind").isin("N", "U"))
    return rows.select(
        F.col("object").alias("asm_name"), F.col("object_start").alias("asm_start"), F.col("object_end").alias("asm_end"), F.col("component").alias("cmp_name"),
        F.col("component_start").cast("long").alias("cmp_start"), F.col("component_end").cast("long").alias("cmp_end"), F.when(F.col("orientation") == "-", -1).otherwise(1).alias("ori"),
    )


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Ungapped blocks of a chain file: chain_id, score, target, target_start, query, query_strand, query_start, length
    (starts from 0). A chain is read as one record, up to the blank line after it; equal ids in two files are chains each."""
    text = spark.read.option("lineSep", "\n\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    records = text.filter("value rlike '^\\\\s*chain '")
    lines = F.split(F.trim("value"), "\n")
    head = F.split(F.get(lines, F.lit(0)), r"\s+")
    field = lambda i: F.get(head, F.lit(i))
    chains = records.select(
        "file", field(12).alias("chain_id"), field(1).cast("long").alias("score"), field(2).alias("target"), field(5).cast("long").alias("t0"), field(7).alias("query"), field(9).alias("query_strand"),
        field(10).cast("long").alias("q0"), F.transform(F.slice(lines, 2, F.size(lines)), lambda x: F.split(F.trim(x), r"\s+")).alias("steps"),
    )
    rows = chains.select("*", F.posexplode("steps").alias("at", "step")).withColumns(
        {"length": F.get("step", F.lit(0)).cast("long"), "dt": F.coalesce(F.get("step", F.lit(1)).cast("long"), F.lit(0)), "dq": F.coalesce(F.get("step", F.lit(2)).cast("long"), F.lit(0))}
    )
    before = Window.partitionBy("file", "chain_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    shift = lambda gap: F.coalesce(F.sum(F.col("length") + F.col(gap)).over(before), F.lit(0))
    return rows.select("chain_id", "score", "target", (F.col("t0") + shift("dt")).alias("target_start"), "query", "query_strand", (F.col("q0") + shift("dq")).alias("query_start"), "length")


def write_sorted(rows: DataFrame, path: str, partitions: int, by: list[str]) -> None:
    """rows as Parquet, ranged and sorted by position, so that later region scans skip row groups."""
    rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by).write.parquet(path)


ASSEMBLY = "name string, role string, molecule string, location string, genbank string, relation string, refseq string, unit string, length string, ucsc string"


def read_assembly_report(spark: SparkSession, path: str) -> DataFrame:
    """A row for each sequence of an assembly report; values of `na` are null, length is a number."""
    rows = _tsv(spark, path, ASSEMBLY)
    plain = [F.when(~F.trim(c).isin("na", ""), F.trim(c)).alias(c) for c in rows.columns if c != "length"]
    return rows.select(*plain, F.trim("length").cast("long").alias("length"))


def synonyms(report: DataFrame) -> DataFrame:
    """name, source, synonym: every other name that an assembly report gives a sequence."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("source"), F.col(c).alias("synonym")) for c in ("genbank", "refseq", "ucsc")])).alias("p")
    return report.select("name", pairs).select("name", "p.*").filter("synonym IS NOT NULL AND synonym <> name")


def read_vulgar(spark: SparkSession, path: str) -> DataFrame:
    """A row for each operation of each vulgar line: hit (a number), query, target, strand, score, nth, op, query_start, query_end,
    target_start, target_end. Starts count from 1 on the forward strand; an operation of no length on a side ends before it starts."""
    lines = spark.read.text(path).filter(F.startswith("value", F.lit("vulgar: "))).withColumn("hit", F.monotonically_increasing_id())
    parts = F.split(F.trim(F.regexp_replace("value", "^vulgar: ", "")), r"\s+")
    names = ("query", "q_from", "q_to", "q_strand", "target", "t_from", "t_to", "t_strand", "score")
    head = lines.select("hit", *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)], F.slice(parts, 10, F.size(parts)).alias("rest"))
    triple = lambda i: F.struct(F.get("rest", i).alias("op"), F.get("rest", i + 1).cast("long").alias("q"), F.get("rest", i + 2).cast("long").alias("t"))
    ops = head.withColumn("ops", F.transform(F.sequence(F.lit(0), F.size("rest") - 3, F.lit(3)), triple))
    rows = ops.select("hit", *names, F.posexplode("ops").alias("nth", "o")).select("hit", *names, "nth", "o.*")
    before = Window.partitionBy("hit").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    done = {side: F.coalesce(F.sum(side).over(before), F.lit(0)) for side in ("q", "t")}

    def low(side: str):
        at = F.col(f"{side}_from").cast("long")
        return F.when(F.col(f"{side}_strand") == "-", at - done[side] - F.col(side)).otherwise(at + done[side]) + 1

    strand = F.when(F.col("t_strand") == "-", -1).otherwise(1)
    placed = rows.withColumns({"query_start": low("q"), "target_start": low("t")})
    return placed.select(
        "hit", "query", "target", strand.alias("strand"), F.col("score").cast("long").alias("score"), "nth", "op",
        "query_start", (F.col("query_start") + F.col("q") - 1).alias("query_end"), "target_start", (F.col("target_start") + F.col("t") - 1).alias("target_end"),
    )


def read_repeatmasker(spark: SparkSession, path: str) -> DataFrame:
    """region, start, end, strand, repeat, family, score, divergence of a RepeatMasker table; its heading is left out."""
    fields = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\d+\s")).select(fields.alias("f"))
    get = lambda i: F.get("f", F.lit(i))
    return rows.select(
        get(4).alias("region"), get(5).cast("long").alias("start"), get(6).cast("long").alias("end"), F.when(get(8) == "C", -1).otherwise(1).alias("strand"),
        get(9).alias("repeat"), get(10).alias("family"), get(0).cast("long").alias("score"), get(1).cast("double").alias("divergence"),
    )


def read_embl(spark: SparkSession, path: str) -> DataFrame:
    """id, accession, description, features (array of kind, location), seq of each record of an EMBL flat file; a record ends
    with a line of two slashes and is never cut."""
    text = F.concat(F.lit("\n"), "value")
    records = spark.read.option("lineSep", "\n//").text(path).filter(F.contains(text, F.lit("\nID ")))
    lines = lambda code: F.array_join(F.regexp_extract_all(text, F.lit(rf"\n{code}   ([^\n]*)"), F.lit(1)), " ")
    kinds = F.regexp_extract_all(text, F.lit(r"\nFT   (\S+)"), F.lit(1))
    places = F.regexp_extract_all(text, F.lit(r"\nFT   \S+\s+(\S+)"), F.lit(1))
    body = F.regexp_replace(F.regexp_extract(text, r"(?s)\nSQ [^\n]*\n(.*)$", 1), r"[^A-Za-z]", "")
    return records.select(
        F.regexp_extract(text, r"\nID   ([^;\s]+)", 1).alias("id"), F.regexp_extract(text, r"\nAC   ([^;\s]+)", 1).alias("accession"), lines("DE").alias("description"),
        F.zip_with(kinds, places, lambda k, p: F.struct(k.alias("kind"), p.alias("location"))).alias("features"), F.upper(body).alias("seq"),
    )


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where a file's split begins), line (rising within a block), value."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return lines.withColumn("line", F.monotonically_increasing_id())


def _last_before(rows: DataFrame, depth: str) -> DataFrame:
    """rows (file, block, line, depth, ...) with parent_block and parent_line: the last line before, in the same file, that
    is one level up. A scan in two levels: within a block, and over the last line of each level of earlier blocks, so a
    parent is found over the borders of splits."""
    place = F.struct("block", "line")
    roles = F.explode(F.array(F.struct(F.col(depth).alias("level"), F.lit(True).alias("up")), F.struct((F.col(depth) - 1).alias("level"), F.lit(False).alias("up"))))
    both = rows.select("file", "block", "line", roles.alias("r")).select("file", "block", "line", "r.level", "r.up")
    within = Window.partitionBy("file", "block", "level").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    own = both.withColumn("_own", F.last(F.when(F.col("up"), place), ignorenulls=True).over(within))
    ends = both.filter("up").groupBy("file", "block", "level").agg(F.max(place).alias("_end"))
    blocks = both.select("file", "block", "level").distinct().join(ends, ["file", "block", "level"], "left")
    along = Window.partitionBy("file", "level").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.withColumn("_earlier", F.last("_end", ignorenulls=True).over(along)).select("file", "block", "level", "_earlier")
    found = own.filter("NOT up").join(earlier, ["file", "block", "level"], "left").withColumn("_p", F.coalesce("_own", "_earlier"))
    return rows.join(found.select("file", "block", "line", F.col("_p.block").alias("parent_block"), F.col("_p.line").alias("parent_line")), ["file", "block", "line"])


def read_net(spark: SparkSession, path: str) -> DataFrame:
    """A row for each line of net files: file, block, line (in order of block and line within a file), parent_block and
    parent_line (null for a net), depth, kind (net, fill or gap), target (the net's sequence), start and size on it, query,
    query_strand, query_start, query_size, and attributes (a map of the pairs that follow; a net has none of these).

    Depth is the number of leading spaces; a parent is the last line before that is one level up. Lines may lie in any
    split. Blank lines and comments are left out."""
    lines = _numbered_lines(spark, path).filter("value rlike '^ *(net|fill|gap) '")
    field = lambda i: F.get("_f", F.lit(i))
    rows = lines.withColumns({"depth": F.length(F.regexp_extract("value", "^( *)", 1)), "_f": F.split(F.trim("value"), r"\s+")}).withColumn("kind", field(0))
    inner = F.col("kind") != "net"
    pairs = F.slice("_f", 8, F.greatest(F.size("_f") - 7, F.lit(0)))
    at = F.sequence(F.lit(0), F.greatest(F.floor(F.size(pairs) / 2).cast("int") - 1, F.lit(0)))
    entries = F.filter(F.transform(at, lambda i: F.struct(F.get(pairs, 2 * i).alias("key"), F.get(pairs, 2 * i + 1).alias("value"))), lambda e: e["value"].isNotNull())
    parsed = rows.select(
        "file", "block", "line", "depth", "kind", F.when(~inner, field(1)).alias("_net"), F.when(inner, field(1).cast("long")).otherwise(0).alias("start"), field(2).cast("long").alias("size"),
        F.when(inner, field(3)).alias("query"), F.when(inner, field(4)).alias("query_strand"), F.when(inner, field(5).cast("long")).alias("query_start"), F.when(inner, field(6).cast("long")).alias("query_size"),
        F.when(inner, F.map_from_entries(entries)).alias("attributes"),
    )
    # the net of a line: within its block, or the last of an earlier one
    within = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nets = parsed.groupBy("file", "block").agg(F.max_by("_net", F.when(F.col("_net").isNotNull(), F.col("line"))).alias("_end"))
    earlier = nets.withColumn("_earlier", F.last("_end", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).drop("_end")
    named = parsed.withColumn("_own", F.last("_net", ignorenulls=True).over(within)).join(earlier, ["file", "block"], "left").withColumn("target", F.coalesce("_own", "_earlier"))
    return _last_before(named.drop("_net", "_own", "_earlier"), "depth")
