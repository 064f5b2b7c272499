"""Text formats round trip through small files; streams give the rows of a batch."""

import random

import pytest
from strandline.functions import sequence as q
from strandline.sources import formats
from strandline.streaming import windows
from pyspark.sql import functions as F


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_gtf(spark, tmp_path):
    line = "chr1\tx\t{}\t{}\t{}\t.\t{}\t.\tgene_id \"g1\"; transcript_id \"t{}\";\n"
    text = "#comment\n" + line.format("exon", 10, 20, "-", 1) + line.format("exon", 40, 50, "-", 1) + line.format("exon", 5, 6, "+", 2) + line.format("CDS", 5, 6, "+", 2)
    found = {r["transcript_id"]: r for r in formats.gtf_models(formats.read_gtf(spark, write(tmp_path, "a.gtf", text))).collect()}
    assert [(e["rank"], e["start"]) for e in found["t1"]["exons"]] == [(1, 40), (2, 10)]
    assert (found["t2"]["start"], found["t2"]["end"], found["t2"]["strand"]) == (5, 6, 1)


def test_gff3(spark, tmp_path):
    rows = ["c\tx\tgene\t1\t90\t.\t+\t.\tID=g1;Name=a%20b", "c\tx\tmRNA\t1\t90\t.\t+\t.\tID=t1;Parent=g1", "c\tx\texon\t1\t30\t.\t+\t.\tParent=t1", "c\tx\texon\t50\t90\t.\t+\t.\tParent=t1"]
    table = formats.read_gff3(spark, write(tmp_path, "a.gff3", "\n".join(rows)))
    assert table.filter("id = 'g1'").first()["name"] == "a b"
    assert sorted((r["gene_id"], r["start"]) for r in formats.gff3_hierarchy(table).collect()) == [("g1", 1), ("g1", 50)]


def test_fasta(spark, tmp_path):
    path = write(tmp_path, "a.fa", ">s1 first one\nACGT\nAC\n>s2\n\n>s3 x\nGGG")
    found = {r["id"]: (r["description"], r["seq"]) for r in formats.read_fasta(spark, path).collect()}
    assert found == {"s1": ("first one", "ACGTAC"), "s2": ("", ""), "s3": ("x", "GGG")}
    formats.write_fasta(formats.read_fasta(spark, path), str(tmp_path / "out"), width=4)
    again = {r["id"]: r["seq"] for r in formats.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert again == {"s1": "ACGTAC", "s2": "", "s3": "GGG"}


def test_fastq(spark, tmp_path):
    found = formats.read_fastq(spark, write(tmp_path, "a.fq", "@r1 a\nACG\n+\nIII\n@r2\nTT\n+r2\nI@\n")).collect()
    assert [(r["id"], r["seq"], r["quality"]) for r in found] == [("r1", "ACG", "III"), ("r2", "TT", "I@")]


def test_fastq_over_parts_of_a_file(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"r{i}", "ACGT" * rng.randint(1, 9)) for i in range(400)]
    path = write(tmp_path, "b.fq", "".join(f"@{n} x\n{s}\n+\n{'@' * len(s)}\n" for n, s in rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        frame = formats.read_fastq(spark, path)
        assert sorted((r["id"], r["seq"], r["quality"]) for r in frame.collect()) == sorted((n, s, "@" * len(s)) for n, s in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="not a FASTQ record"):
        formats.read_fastq(spark, write(tmp_path, "c.fq", "@r1\nACG\n+\nII\n")).collect()


def test_junctions_agp_chain(spark, tmp_path):
    rows = formats.read_junctions(spark, write(tmp_path, "sj.tab", "1\t5\t9\t1\t1\t0\t3\t3\n1\t5\t9\t1\t1\t0\t1\t0\n"))
    assert formats.junction_depth(rows).first()["depth"] == 6
    agp = formats.read_agp(spark, write(tmp_path, "a.agp", "o\t1\t10\t1\tW\tc1\t1\t10\t-\no\t11\t20\t2\tN\t10\tscaffold\tyes\tx\n")).collect()
    assert [(r["cmp_name"], r["ori"]) for r in agp] == [("c1", -1)]
    chain = "chain 99 t 100 + 10 40 q 90 - 5 30 7\n10 5 2\n8 0 3\n4\n\nchain 5 t 9 + 0 3 q 9 + 0 3 8\n3\n\n"
    found = sorted(map(tuple, formats.read_chain(spark, write(tmp_path, "a.chain", chain)).select("chain_id", "target_start", "query_start", "length").collect()))
    assert found == [("7", 10, 5, 10), ("7", 25, 17, 8), ("7", 33, 28, 4), ("8", 0, 0, 3)]


def test_codon_cigar_and_frames(spark):
    rows = spark.createDataFrame([("45M432378I78M543C987I435C67M678263I78M", "ATGAAATAGATGCCCTAAA"), ("45M2I", "NNNAC"), (None, None)], "c string, s string")
    found = rows.select(q.merged_codons(F.col("c")).alias("c"), q.translated(F.col("s")).alias("p"), q.open_frames(q.translated(F.col("s"))).alias("o")).collect()
    assert [r["c"] for r in found] == ["45M432378I621M987I502M678263I78M", "45M2I", None]
    assert [r["p"] for r in found] == ["MK*MP*", "X", None]
    assert [(o["start"], o["length"]) for o in found[0]["o"]] == [(0, 2), (3, 2)]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events"))
    stream = windows.windowed_counts(windows.read_events(spark, str(tmp_path / "events"), events.schema), late="60 days")
    table = windows.to_table(stream, "counted", str(tmp_path / "state"), "complete")
    batch = windows.windowed_counts(events)
    key = lambda r: (r["window_start"], r["event_type"], r["n"], round(r["total"], 4))
    assert sorted(map(key, table.collect())) == sorted(map(key, batch.collect()))


def test_assembly_report(spark, tmp_path):
    line = "1\tassembled-molecule\t1\tChromosome\tCM1.2\t=\tNC_1.1\tPrimary\t123\tchr1\r\n"
    report = formats.read_assembly_report(spark, write(tmp_path, "r.txt", "# Name\n" + line + "s2\tunplaced-scaffold\tna\tna\tKK.1\t<>\tna\tPrimary\t9\tna\n"))
    assert [(r["name"], r["molecule"], r["refseq"], r["length"], r["ucsc"]) for r in report.orderBy("name").collect()] == [("1", "1", "NC_1.1", 123, "chr1"), ("s2", None, None, 9, None)]
    assert sorted(tuple(r) for r in formats.synonyms(report).collect()) == [("1", "genbank", "CM1.2"), ("1", "refseq", "NC_1.1"), ("1", "ucsc", "chr1"), ("s2", "genbank", "KK.1")]


def test_vulgar(spark, tmp_path):
    text = "Command line: x\nvulgar: p1 0 10 . chr1 100 140 + 55 M 4 12 I 0 10 M 6 18\nvulgar: p2 2 6 . chr2 50 38 - 9 M 1 3 G 1 0 M 2 9\n"
    rows = formats.read_vulgar(spark, write(tmp_path, "v.txt", text)).orderBy("hit", "nth").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("p1", "chr1", 1, 55, 0, "M", 1, 4, 101, 112), ("p1", "chr1", 1, 55, 1, "I", 5, 4, 113, 122), ("p1", "chr1", 1, 55, 2, "M", 5, 10, 123, 140),
        ("p2", "chr2", -1, 9, 0, "M", 3, 3, 48, 50), ("p2", "chr2", -1, 9, 1, "G", 4, 4, 48, 47), ("p2", "chr2", -1, 9, 2, "M", 5, 6, 39, 47),
    ]


def test_repeatmasker_and_embl(spark, tmp_path):
    table = "   SW  perc\nscore  div.\n\n  463   1.3  0.6  1.7  chr1  10001   10468 (243) +  (TAACCC)n  Simple_repeat  1  463 (0) 1\n  239  29.4  1.9  1.0  chr1  10469  11447 (1) C  TAR1  Satellite (399) 1712  483 2\n"
    rows = formats.read_repeatmasker(spark, write(tmp_path, "r.out", table)).orderBy("start").collect()
    assert [tuple(r) for r in rows] == [("chr1", 10001, 10468, 1, "(TAACCC)n", "Simple_repeat", 463, 1.3), ("chr1", 10469, 11447, -1, "TAR1", "Satellite", 239, 29.4)]
    record = "ID   X1; SV 1; linear; DNA\nAC   X1;\nDE   first line\nDE   second\nFT   source          1..8\nFT                   /organism=\"h\"\nFT   CDS             join(1..3,5..7)\nSQ   Sequence 8 BP;\n     acgt acgt        8\n//\n"
    found = formats.read_embl(spark, write(tmp_path, "e.embl", record + record.replace("X1", "X2"))).orderBy("id").collect()
    assert [(r["id"], r["accession"], r["description"], r["seq"]) for r in found] == [(n, n, "first line second", "ACGTACGT") for n in ("X1", "X2")]
    assert [(f["kind"], f["location"]) for f in found[0]["features"]] == [("source", "1..8"), ("CDS", "join(1..3,5..7)")]


def test_coding_of_gtf_models(spark, tmp_path):
    line = lambda f, a, b, strand, frame, t: f'c\tx\t{f}\t{a}\t{b}\t.\t{strand}\t{frame}\tgene_id "g"; transcript_id "{t}";'
    rows = [line("exon", 1, 30, "+", ".", "a"), line("CDS", 4, 20, "+", "2", "a"), line("exon", 41, 60, "+", ".", "a"), line("CDS", 41, 50, "+", "1", "a"), line("stop_codon", 51, 53, "+", "0", "a")]
    rows += [line("exon", 1, 30, "-", ".", "b"), line("CDS", 4, 20, "-", "2", "b"), line("CDS", 25, 29, "-", "1", "b")]
    # without CDS: ATG GCA | GCA TAA over two exons, forward; the same backward; and none
    plus = "CC" + "ATGGCA" + "GTAAAG" + "GCATAA" + "CCC"
    turn = str.maketrans("ACGT", "TGCA")
    rows += [line("exon", 1, 8, "+", ".", "d").replace("c\t", "s\t", 1), line("exon", 15, 23, "+", ".", "d").replace("c\t", "s\t", 1)]
    n = len(plus)
    rows += [line("exon", n - 7, n, "-", ".", "e").replace("c\t", "r\t", 1), line("exon", n - 22, n - 14, "-", ".", "e").replace("c\t", "r\t", 1), line("exon", 9, 14, "+", ".", "f").replace("c\t", "s\t", 1)]
    table = formats.read_gtf(spark, write(tmp_path, "c.gtf", "\n".join(rows)))
    seqs = spark.createDataFrame([("c", "N" * 60), ("s", plus), ("r", plus.translate(turn)[::-1])], "seqname string, seq string")
    got = {r["transcript_id"]: (r["cds_start"], r["cds_end"], r["phase"], r["coding"]) for r in formats.gtf_coding_models(table, seqs).collect()}
    assert got == {"a": (4, 53, 2, "given"), "b": (4, 29, 1, "given"), "d": (3, 20, 0, "chosen"), "e": (n - 19, n - 2, 0, "chosen"), "f": (None, None, None, None)}


def test_coding_of_gff3(spark, tmp_path):
    rows = ["c\tx\tCDS\t10\t20\t.\t-\t0\tID=c1;Parent=t1,t2", "c\tx\tCDS\t30\t41\t.\t-\t2\tID=c1;Parent=t1"]
    table = formats.read_gff3(spark, write(tmp_path, "c.gff3", "\n".join(rows)))
    assert sorted((r["parent"], r["cds_start"], r["cds_end"], r["phase"]) for r in formats.gff3_coding(table).collect()) == [("t1", 10, 41, 2), ("t2", 10, 20, 0)]
