"""Interval algebra, clusters and greedy selection against brute force on random rows."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import clusters, graph, intervals, projection, ranking


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(300):
        start = rng.randint(1, 400)
        out.append((i, rng.choice([1, 1, 1, 2]), start, start + rng.randint(0, 12)))
    return out + [(900, 3, 1, 5), (901, 3, 6, 9), (902, 3, 9, 9), (903, 4, 7, 7)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, region long, start long, end long")


def islands(rows, gap=0):
    out = []
    for region in sorted({r[1] for r in rows}):
        now = None
        for _, _, s, e in sorted((r for r in rows if r[1] == region), key=lambda r: (r[2], r[3])):
            if now and s <= now[2] + gap:
                now[2] = max(now[2], e)
                now[3] += 1
            else:
                now = [region, s, e, 1]
                out.append(now)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("gap", [0, 1, 7])
@pytest.mark.parametrize("width", [1, 16, 100000])
def test_merged(frame, rows, gap, width):
    assert sorted(map(tuple, intervals.merged(frame, ["region"], gap, width).collect())) == islands(rows, gap)


@pytest.mark.parametrize("width", [1, 8, 1000])
def test_overlap_pairs(frame, rows, width):
    found = intervals.overlaps(frame, frame, ["region"], width).select("id", "r_id").collect()
    assert sorted(map(tuple, found)) == sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] <= b[3] and a[3] >= b[2])


def test_depth_and_zones(frame, rows):
    at = {}
    for _, region, s, e in rows:
        for p in range(s, e + 1):
            at[region, p] = at.get((region, p), 0) + 1
    found = {(r["region"], p): r["depth"] for r in intervals.depth(frame, ["region"], 16).collect() for p in range(r["start"], r["end"] + 1)}
    assert found == at
    zones = intervals.saturated_zones(frame, ["region"], 3, 2, 16).collect()
    high = {k for k, d in at.items() if d >= 3}
    covered = {(z["region"], p) for z in zones for p in range(z["start"], z["end"] + 1)}
    assert covered <= high and all((k[0], k[1] - 1) not in high and (k[0], k[1] + 1) not in high for k in high - covered)


def test_subtraction(frame, rows):
    left, right = frame.filter("id % 2 = 0"), frame.filter("id % 3 = 0")
    gone = {(r[1], p) for r in rows if r[0] % 3 == 0 for p in range(r[2], r[3] + 1)}
    found = {}
    for r in intervals.subtracted(left, right, ["region"], ["id"], 8).collect():
        found.setdefault(r["id"], set()).update(range(r["start"], r["end"] + 1))
    for i, region, s, e in rows:
        if i % 2 == 0:
            assert found.get(i, set()) == {p for p in range(s, e + 1) if (region, p) not in gone}


def test_empty(frame):
    none = frame.limit(0)
    assert intervals.merged(none, ["region"]).count() == 0
    assert intervals.overlaps(frame, none, ["region"]).count() == 0
    assert intervals.subtracted(frame, none, ["region"], ["id"]).count() == frame.count()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (600, 600)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(201)) and found[501] == 500 and found[600] == 600


def test_exon_clusters_link_through_shared_exons(spark):
    exons = [(1, 1, 10), (2, 5, 20), (3, 18, 30), (4, 40, 50), (5, 11, 12), (5, 45, 46)]
    frame = spark.createDataFrame([(g, 7, s, e) for g, s, e in exons], "gene_id long, region long, start long, end long")
    found = {r["gene_id"]: r["cluster"] for r in clusters.exon_clusters(frame, ["region"]).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_greedy_selection(spark, rows):
    rng = random.Random(3)
    scored = [(*r, rng.randint(1, 20)) for r in rows]
    frame = spark.createDataFrame(scored, "id long, region long, start long, end long, score long")
    kept = []
    for i, region, s, e, _ in sorted(scored, key=lambda r: (-r[4], r[0])):
        if all(k[1] != region or s > k[3] or e < k[2] for k in kept):
            kept.append((i, region, s, e))
    assert sorted(r["id"] for r in ranking.non_overlapping(frame, ["region"], "score", "id", 16).collect()) == sorted(k[0] for k in kept)


def test_depth_cap(spark):
    hits = [("a", 1, 10, 9.0), ("b", 1, 10, 8.0), ("c", 1, 10, 7.0), ("d", 5, 12, 6.0), ("c", 50, 60, 1.0)]
    frame = spark.createDataFrame([(h, 1, s, e, v, 99.0) for h, s, e, v in hits], "hit string, region long, start long, end long, score double, identity double")
    kept = ranking.depth_capped(frame, ["region"], "hit", "score", 2, 90.0)
    # c has three hits' depth before it on its first place, but none on its second; d reaches bases 11 and 12
    assert sorted(r["hit"] for r in kept.collect()) == ["a", "b", "c", "d"]


def test_projection_through_reversed_block(spark):
    rows = spark.createDataFrame([(1, "x", 5, 8)], "id long, region string, start long, end long")
    blocks = spark.createDataFrame([("x", 1, 10, "t", 101, 1), ("x", 1, 10, "u", 201, -1)], "region string, start long, end long, target string, target_start long, orientation int")
    found = {r["target"]: (r["target_start"], r["target_end"]) for r in projection.projected(rows, blocks, ["region"]).collect()}
    assert found == {"t": (105, 108), "u": (203, 206)}


def test_layers_block_but_do_not_show(spark):
    genes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "c")], "gene_id long, biotype string")
    exons = spark.createDataFrame([(1, 1, 1, 10), (2, 1, 20, 30), (3, 1, 25, 40), (4, 1, 60, 70)], "gene_id long, region long, start long, end long")
    layers = [("one", ["a"], [], False), ("two", ["b"], ["one"], True), ("three", ["c"], ["one", "two"], False)]
    found = ranking.layered(genes, exons, layers, ["region"], 16)
    assert sorted((r["gene_id"], r["layer"]) for r in found.collect()) == [(1, "one"), (4, "three")]
    assert found.filter(F.col("layer") == "two").count() == 0


def test_exon_clusters_across_zones_and_what_tasks_let_go_of(spark, monkeypatch):
    rng = random.Random(5)
    exons = []
    for gene in range(300):
        at, region = rng.randint(-3000, 3000), rng.choice([1, 1, 1, 2])
        for _ in range(rng.randint(1, 3)):
            exons.append((gene, region, at, at + rng.choice([3, 5, 9, 700 if gene % 50 == 0 else 4])))
            at += rng.randint(10, 60)
    root = {g: g for g, *_ in exons}
    for _ in range(len(root)):
        after = dict(root)
        for a in exons:
            for b in exons:
                if a[1] == b[1] and a[2] <= b[3] and a[3] >= b[2]:
                    after[a[0]] = min(after[a[0]], after[b[0]])
        if after == root:
            break
        root = after
    loose = [(900, None, 1, 5), (901, 1, 1, None), (None, 1, 1, 5)]
    frame = spark.createDataFrame(exons + loose, "gene_id long, region long, start long, end long")
    monkeypatch.setattr(clusters, "ZONE_BINS", 1)
    for width in (16, 400, 100_000):
        found = clusters.exon_clusters(frame, ["region"], scan_bin=width).collect()
        assert len(found) == len(root) and {r["gene_id"]: r["cluster"] for r in found} == root
    # a task that lets go of its nodes all the time leaves the rest to the rounds
    chain = spark.createDataFrame([(i, i + 1) for i in range(5000)] + [(9000, 9000)], "a long, b long").coalesce(1)
    stars = graph.forests(chain, most=7)
    rows = graph.settled(stars).collect()
    assert len(rows) == 5002 and all(r["root"] == (0 if r["node"] <= 5000 else 9000) for r in rows)


def test_exon_clusters_read_their_exons_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    exons = spark.range(1000).selectExpr("id AS gene_id", "id % 3 AS region", "id AS start", "id + 1 AS end")
    found = clusters.exon_clusters(exons.mapInPandas(count, exons.schema), ["region"])
    assert found.count() == 1000 and seen.value == 1000
