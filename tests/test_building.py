"""Composite gene-building rules on small hand-made rows."""

import random

from strandline.operators import audit, building, classify, factories, filters, models
from pyspark.sql import functions as F


def test_readthroughs(spark):
    spans = {1: [(1, 10)], 2: [(20, 24), (28, 30)], 4: [(40, 50)], 5: [(8, 12)]}
    # 3 bridges 1 and 2 but misses an exon of 2; 7 bridges them over all their exons and stays; 6 meets 40-50 alone; 8 takes
    # under a twentieth of the single exon of 9
    spans |= {3: [(5, 9), (20, 25)], 6: [(30, 41)], 7: [(2, 12), (21, 23), (28, 31)], 9: [(100, 199)], 10: [(230, 240)], 8: [(196, 198), (230, 330)]}
    rows = [(i, 1, own[0][0], own[-1][1], [{"start": s, "end": e} for s, e in own]) for i, own in spans.items()]
    frame = spark.createDataFrame(rows, "gene_id long, region long, start long, end long, exons array<struct<start:long,end:long>>")
    assert sorted(r["gene_id"] for r in building.readthroughs(frame, ["region"], "gene_id").collect()) == [3, 8]


def test_set_cover(spark):
    rows = [(1, "a", v) for v in (1, 2, 3)] + [(1, "b", v) for v in (3, 4)] + [(1, "c", v) for v in (1, 2)] + [(2, "z", 9)]
    frame = spark.createDataFrame(rows, "grp long, who string, value long")
    found = sorted(map(tuple, building.set_cover(frame, ["grp"], "who", "value", 4).collect()))
    assert found == [(1, 1, "a", 3), (1, 2, "b", 1), (2, 1, "z", 1)]


def test_bins_advance_by_one(spark):
    frame = spark.createDataFrame([(i, 1, n) for i, n in enumerate([100, 90, 10, 9, 8, 7])], "gene_id long, region long, length long")
    found = {r["length"]: r["bin"] for r in building.frame_bins(frame, ["region"], "length").collect()}
    assert found == {100: 0, 90: 0, 10: 1, 9: 2, 8: 3, 7: 3}


def test_paths_and_descendants(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 1, 3), (1, 3, 1)], "g long, a long, b long")
    ends = spark.createDataFrame([(1, 3)], "g long, node long")
    starts = spark.createDataFrame([(1, 1)], "g long, node long")
    assert sorted(r["path"] for r in building.paths(edges, starts, ends, ["g"], 2).collect()) == ["1.2.3", "1.3"]
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "node string, parent string")
    assert sorted(map(tuple, building.descendants(tree, 9).collect())) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]


def test_named_filters_and_models(spark):
    rows = spark.createDataFrame([(1, "x", [(1, 1, 5), (2, 10, 12), (3, 100, 101)]), (2, "y", [(1, 1, 2)])], "gene_id long, biotype string, exons array<struct<rank:int,start:bigint,end:bigint>>")
    assert filters.apply_named(rows, "exon_count", least=2).count() == 1
    assert filters.apply_named(rows, "intron_lengths", longest=10).select("gene_id").collect()[0][0] == 2
    assert filters.apply_named(rows, "biotypes", names=["x"]).count() == 1
    got = rows.select(models.chain_key(models.introns(F.col("exons"))).alias("c"), models.trimmed_ends(F.col("exons"), 3).alias("t")).collect()
    assert [r["c"] for r in got] == ["6:9:13:99", ""] and [len(r["t"]) for r in got] == [2, 0]


def test_gene_vote(spark):
    rows = spark.createDataFrame([(1, "pseudo"), (1, "real"), (2, "pseudo"), (2, "repeat"), (2, "repeat")], "gene_id long, call string")
    assert dict(map(tuple, classify.gene_vote(rows).collect())) == {1: "real", 2: "repeat"}


def test_batches(spark):
    rows = spark.createDataFrame([(i,) for i in range(25)], "id long")
    sizes = sorted(r["count"] for r in factories.count_batches(rows, "id", 10).groupBy("batch").count().collect())
    assert sizes == [5, 10, 10]
    assert [r["start"] for r in factories.windows(spark.createDataFrame([("x", 100)], "region string, length long"), 40, 10).orderBy("start").collect()] == [1, 31, 61]


def test_audit_reports_missing_groups(spark):
    rows = spark.createDataFrame([("a",), ("a",)], "kind string")
    found = audit.below_minimum(rows, "kind", {"a": 2, "b": 1}, "t").collect()
    assert [(r["key"], r["found"]) for r in found] == [("b", "0")]


def test_path_facts_equal_all_paths(spark):
    """Counts, longest and first paths as of paths laid out one by one: parallel edges, cycles, names that sort around dots;
    and a graph of 2 ** 40 paths."""
    rng = random.Random(4)
    names = ["1", "1-1", "1!", "10", "2", "a"]
    edges = [(g, rng.choice(names), rng.choice(names)) for g in range(25) for _ in range(rng.randint(1, 9))] + [(0, None, "1"), (0, "1", None), (None, "1", "2")]
    starts, ends = ([(g, rng.choice(names)) for g in range(25) for _ in range(2)] + [(1, None), (None, "1")] for _ in range(2))
    edges, starts, ends = (spark.createDataFrame(x, s).cache() for x, s in ((edges, "g long, a string, b string"), (starts, "g long, node string"), (ends, "g long, node string")))
    wanted = building.paths(edges, starts, ends, ["g"], 4).groupBy("g").agg(F.count(F.lit(1)), F.max("length"), F.min("path"))
    found = building.path_facts(edges, starts, ends, ["g"], 4)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect())) != []
    # forty stages of two nodes, every one joined to both of the next
    stages = [(1, f"{i}{x}", f"{i + 1}{y}") for i in range(40) for x in "ab" for y in "ab"]
    one = building.path_facts(spark.createDataFrame(stages, "g long, a string, b string"), *[spark.createDataFrame([(1, n)], "g long, node string") for n in ("0a", "40a")], ["g"], 40).collect()
    assert [tuple(r)[:3] for r in one] == [(1, 2**39, 40)] and one[0]["first_path"] == ".".join(f"{i}a" for i in range(41))
