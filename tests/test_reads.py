"""Inputs that several steps use are computed once."""

from strandline.operators import audit, classify, curation, refinement


def counted(spark, rows):
    """rows, and a counter of how many of them have been computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    return rows.mapInPandas(count, rows.schema), seen


def test_gene_sanity(spark):
    genes, g = counted(spark, spark.range(50).selectExpr("id AS gene_id", "1L AS region", "10L AS start", "IF(id = 7, 99L, 20L) AS end"))
    transcripts, t = counted(spark, spark.range(50).selectExpr("id AS transcript_id", "id AS gene_id", "1L AS region", "1 AS strand", "10L AS start", "20L AS end", "'x' AS biotype"))
    exons = spark.range(50).selectExpr("string(id) AS exon_id", "IF(id = 1, 2L, 1L) AS region", "IF(id IN (1, 2), -1, 1) AS strand", "IF(id = 3, 9L, 10L) AS start", "20L AS end")
    links = spark.range(50).selectExpr("id AS transcript_id", "string(id) AS exon_id")
    ends = spark.createDataFrame([], "transcript_id long, start_exon string, end_exon string")
    found = sorted(tuple(r) for r in audit.gene_sanity(genes, transcripts, links, exons, ends).collect())
    assert found == [("bounds", "gene", "7", "10:20"), ("outside", "exon", "3:3", "9:20"), ("region", "exon", "1:1", "2"), ("strand", "exon", "1:1", "-1"), ("strand", "exon", "2:2", "-1")]
    assert (g.value, t.value) == (50, 50)


def test_model_evidence(spark):
    exons = spark.createDataFrame([(1, 1, 1, 10), (1, 1, 41, 50), (2, 1, 101, 110)], "gene_id long, region long, start long, end long")
    repeats, r = counted(spark, spark.createDataFrame([(1, 6, 25), (1, 20, 30)], "region long, start long, end long"))
    found = {row["gene_id"]: (row["covered_exons"], row["covered_introns"]) for row in classify.model_evidence(exons, repeats, ["region"], 20).collect()}
    assert found == {1: (25.0, 66.6667), 2: (0.0, 0.0)}
    assert r.value == 2


def test_covered_single_introns_count_overlapping_pieces_once(spark):
    exons = spark.createDataFrame([(g, 1, s, s + 9) for g in (1, 2) for s in (1, 111)], "gene_id long, region long, start long, end long")
    hits = [(1, 7, 11, 25), (1, 7, 20, 30), (1, 7, 100, 300), (1, 8, 5, 45), (2, 7, 11, 30), (2, 7, 11, 30), (2, 8, 11, 110), (2, None, 11, 110)]
    features = spark.createDataFrame([(g, h, 1, s, e) for g, h, s, e in hits], "gene_id long, hit long, region long, start long, end long")
    assert [r["gene_id"] for r in classify.covered_single_introns(exons, features, ["region"], 20, 30.0).collect()] == [1]


def test_built_genes(spark):
    models, m = counted(
        spark,
        spark.range(40).selectExpr(
            "id AS gene_id", "1L AS region", "100 * id AS start", "100 * id + 60 AS end", "'x' AS biotype", "array(named_struct('start', 100 * id, 'end', 100 * id + 20), named_struct('start', 100 * id + 41, 'end', 100 * id + 60)) AS exons",
            "string(id) AS coding", "false AS has_utr", "id AS place",
        ),
    )
    found = {r["gene_id"]: r["gene"] for r in curation.built_genes(models, ["region"], ["place"], [], (5, 15), 3).collect()}
    assert found == {i: i for i in range(40)}
    assert m.value == 40


def test_capped_hits(spark):
    hits, h = counted(spark, spark.range(60).selectExpr("id % 2 AS region", "1 AS strand", "id AS start", "id + 9 AS end", "id % 20 AS name", "double(id) AS score", "0.001D AS p_value"))
    kept = [refinement.capped_hits(hits, ["region"], "name", 4, 0.1, 2, 64, most) for most in (30, 29)]
    assert h.value == 120
    found = [sorted(tuple(r) for r in x.collect()) for x in kept]
    assert found[0] == found[1] and 0 < len(found[0]) < 60
    assert h.value == 120
