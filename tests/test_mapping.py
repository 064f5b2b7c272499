"""Alignment against the whole matrix, maps, clusters and cuts against plain loops, the net reader against a plain parser."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandline import queries
from strandline.operators import alignment, factories, hits, intervals, projection, sequences
from strandline.plans import mapping_queries
from strandline.sources import driver_tables as t
from strandline.sources import formats

SF = "/root/testdata/sf0.001"


def whole_matrix(a, b, match=2, mismatch=-1, gap=-2):
    """score, identical, aligned of the best global alignment: most identical, then most aligned, of equal scores."""
    row = [(gap * j, 0, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [(gap * i, 0, 0)]
        for j, y in enumerate(b, 1):
            s, m, n = row[j - 1]
            same = x == y
            through = (s + (match if same else mismatch), m + same, n + 1)
            new.append(max(through, (row[j][0] + gap, *row[j][1:]), (new[-1][0] + gap, *new[-1][1:])))
        row = new
    return row[-1]


def test_alignment_equals_the_whole_matrix():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ACGTé") for _ in range(n))
    pairs = [("", ""), ("", "ACG"), ("ACGT", ""), ("A", "A"), ("ACGT", "TGCA")] + [(word(rng.randint(0, 60)), word(rng.randint(0, 60))) for _ in range(60)]
    for _ in range(40):  # near copies, also with long parts lost
        a = word(rng.randint(30, 90))
        b = list(a)
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice([0, 1, 1, 25])] = word(rng.choice([0, 1, 3]))
        pairs.append((a, "".join(b)))
    for half in (1, 4, 16):
        found = alignment.aligned([p[0] for p in pairs], [p[1] for p in pairs], half=half)
        assert [tuple(x) for x in found.tolist()] == [whole_matrix(*p) for p in pairs]


def test_identities(spark):
    rows = [(1, "ACGTACGT", "ACGTACGT"), (2, "ACGTACGT", "ACGACGT"), (3, None, "A"), (4, "", "A"), (5, "AAAA", "TTTT")]
    found = alignment.identities(spark.createDataFrame(rows, "id long, a string, b string"), "a", "b").collect()
    got = {r["id"]: (r["identical"], r["aligned"], r["identity"], r["coverage"]) for r in found}
    assert got == {1: (8, 8, 100.0, 100.0), 2: (7, 7, 100.0, 87.5), 3: (None, None, None, None), 4: (0, 0, 0.0, 0.0), 5: (0, 4, 0.0, 100.0)}


def test_aligned_names_query(spark):
    found = queries.QUERIES["aligned_names"](spark, SF).collect()
    names = {r["p_partkey"]: r["p_name"] for r in t.table(spark, SF, "part").collect()}
    assert len(found) > 20
    for r in found:
        assert (r["score"], r["identical"], r["aligned"]) == whole_matrix(names[r["p_partkey"]], r["other"])
        assert r["coverage"] == pytest.approx(100 * r["aligned"] / len(names[r["p_partkey"]]), abs=1e-4)
    best = {r["p_partkey"]: r for r in queries.QUERIES["best_aligned_names"](spark, SF).collect()}
    for r in found:
        assert round(best[r["p_partkey"]]["coverage"] + best[r["p_partkey"]]["identity"], 4) >= round(r["coverage"] + r["identity"], 4)


def plain_map(blocks):
    """Parts (id, start, end, target_start) of blocks (id, start, end, target_start, score), base by base."""
    taken = []
    for name, s, e, ts, _ in sorted(blocks, key=lambda b: (-b[4], b[0])):
        shift = ts - s
        left = [p for p in range(s, e + 1) if not any(a <= p <= b or c <= p + shift <= d for _, a, b, c, d in taken)]
        parts = []
        for p in left:
            if parts and parts[-1][1] == p - 1:
                parts[-1][1] = p
            else:
                parts.append([p, p])
        if all(sum(x[1] < a for x in taken) == sum(x[3] < a + shift for x in taken) for a, _ in parts):
            taken += [(name, a, b, a + shift, b + shift) for a, b in parts]
    return sorted(x[:4] for x in taken)


@pytest.mark.parametrize("seed", range(3))
def test_one_to_one_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 3), s, s + rng.randint(0, 60), s + rng.choice([0, 0, 5, -7, 40]) + 100, float(rng.randint(1, 30))) for i in range(80) for s in [rng.randint(1, 500)]]
    frame = spark.createDataFrame(rows, "block_id long, region long, start long, end long, target_start long, score double")
    found = defaultdict(list)
    for r in projection.one_to_one(frame, ["region"], "block_id", "score").collect():
        found[r["region"]].append((r["block_id"], r["start"], r["end"], r["target_start"]))
    for region in range(4):
        assert sorted(found[region]) == plain_map([(r[0], *r[2:]) for r in rows if r[1] == region])


def test_one_to_one_query(spark):
    blocks, found = defaultdict(list), defaultdict(list)
    for r in mapping_queries.map_blocks(spark, SF).collect():
        blocks[r["region"]].append((r["block_id"], r["start"], r["end"], r["target_start"], r["score"]))
    for r in queries.QUERIES["one_to_one_blocks"](spark, SF).collect():
        found[r["region"]].append((r["block_id"], r["start"], r["end"], r["target_start"]))
    for region, own in blocks.items():
        assert sorted(found[region]) == plain_map(own)


def test_projected_models(spark):
    blocks = spark.createDataFrame([(1, 1, 100, "h", 1, 1), (1, 103, 200, "h", 102, 1), (1, 301, 400, "h", 301, 1), (1, 390, 500, "k", 1, -1)], "region long, start long, end long, target string, target_start long, orientation int")
    rows = [
        (1, 1, 1, 10, 50, True), (1, 1, 2, 95, 120, True),  # over a gap of two that is joined but lacks two bases
        (2, 1, 1, 10, 50, True), (2, 1, 2, 110, 130, False),
        (3, 1, 1, 10, 50, True), (3, 1, 2, 190, 230, False), (4, 1, 1, 210, 220, True), (5, 1, 1, 220, 290, False), (5, 1, 2, 310, 320, True), (6, 1, 1, 380, 450, True),
    ]
    exons = spark.createDataFrame(rows, "gene_id long, region long, rank int, start long, end long, coding boolean")
    found = {r["gene_id"]: (r["status"], r["whole"], r["cut"], r["lost"], r["mapped"], r["target"]) for r in projection.projected_models(exons, blocks, ["region"], 3).collect()}
    assert found == {1: ("partial", 1, 1, 0, 65, "h"), 2: ("complete", 2, 0, 0, 62, "h"), 3: ("coding", 1, 1, 0, 52, "h"), 4: ("lost", 0, 0, 1, 0, None), 5: ("coding", 1, 0, 1, 11, "h"), 6: ("partial", 0, 1, 0, 61, "k")}


def plain_clusters(rows):
    """row_id -> cluster, meta of (row_id, spans) on one strand."""
    clusters, metas, out = [], [], {}
    over = lambda a, b: a[0] <= b[1] and b[0] <= a[1]
    for name, spans in sorted(rows, key=lambda r: (r[1][0][0], -r[1][-1][1], r[0])):
        own = [(a[1] + 1, b[0] - 1) for a, b in zip(spans, spans[1:])]
        whole = (spans[0][0], spans[-1][1])
        for c in clusters:
            if not (whole[0] >= c["span"][0] and whole[1] <= c["span"][1]) or any(over(x, i) for x in spans for i in c["introns"]):
                continue
            start, bad = c["span"][0], False
            for i in [*c["introns"], None]:
                end = i[0] - 1 if i else c["span"][1]
                bad |= any(over((start, end), x) for x in own)
                start = i[1] + 1 if i else start
            if not bad:
                out[name] = c["name"]
                break
        else:
            clusters.append({"span": whole, "introns": own, "name": name})
            out[name] = name
    belongs = {}
    for c in clusters:
        meta = next((m for m in metas if over(m[1], c["span"])), None)
        if meta is None:
            meta = (c["name"], c["span"])
            metas.append(meta)
        belongs[c["name"]] = meta[0]
    return {n: (c, belongs[c]) for n, c in out.items()}


def test_intron_clusters_equal_the_loop(spark):
    rng = random.Random(15)
    rows = []
    for i in range(250):
        at, spans = rng.randint(1, 600), []
        for _ in range(rng.randint(1, 4)):
            spans.append((at, at + rng.randint(3, 15)))
            at = spans[-1][1] + rng.randint(2, 20)
        rows.append((i, rng.choice([1, -1]), [s for s, _ in spans], [e for _, e in spans]))
    found = hits.intron_clusters(spark.createDataFrame(rows, "hit long, strand int, starts array<long>, ends array<long>"), ["strand"], "hit", 64)
    wanted = {}
    for strand in (1, -1):
        wanted |= plain_clusters([(r[0], list(zip(r[2], r[3]))) for r in rows if r[1] == strand])
    assert {r["hit"]: (r["cluster"], r["meta"]) for r in found.collect()} == wanted
    assert len({c for c, _ in wanted.values()}) > len({m for _, m in wanted.values()}) > 5


def test_intron_clusters_query(spark):
    models, place = defaultdict(list), {}
    for r in t.snapped(spark, SF).collect():
        models[r["gene_id"]].append((r["start"], r["end"]))
        place[r["gene_id"]] = (r["region"], r["strand"])
    groups = defaultdict(list)
    for g, spans in models.items():
        groups[place[g]].append((g, sorted(spans)))
    wanted = {}
    for own in groups.values():
        wanted |= plain_clusters(own)
    assert {r["gene_id"]: (r["cluster"], r["meta"]) for r in queries.QUERIES["intron_consistent_clusters"](spark, SF).collect()} == wanted


def looped_cuts(depth, length, window, step, first, least_bases, least_depth):
    out, current, i = [], 1, first
    while i < length - window:
        start, end = i, i + window
        if sum(depth.get(p, 0) > least_depth for p in range(start - 1, end - 1)) < least_bases:
            middle = (start + end) // 2
            out.append((current, middle))
            current = middle + 1
            if current >= length:
                return out
            if current + first >= length:
                return [*out, (current, length)]
            i = middle + first - step
        i += step
    return [*out, (current, length)]


def test_low_coverage_cuts(spark):
    rng = random.Random(1)
    reads, regions, wanted = [], [], []
    for region in range(12):
        length = rng.randint(30, 900)
        own = [(s, min(length, s + rng.randint(5, 40))) for s in (rng.randint(1, length) for _ in range(rng.choice([0, 20, 60, 200])))]
        depth = defaultdict(int)
        for s, e in own:
            for p in range(s, e + 1):
                depth[p] += 1
        reads += [(region, s, e) for s, e in own]
        regions.append((region, length))
        wanted += [(region, *x) for x in looped_cuts(depth, length, 50, 7, 40, 15, 2)]
    runs = intervals.depth(spark.createDataFrame(reads, "region long, start long, end long"), ["region"], 64)
    found = factories.low_coverage_cuts(spark.createDataFrame(regions, "region long, length long"), runs, 50, 7, 40, 15, 2)
    assert sorted(map(tuple, found.collect())) == sorted(wanted) and len(wanted) >= 30


def test_low_coverage_cuts_with_missing_values(spark):
    """Reads without an end cover nothing, and reads of a missing region cut that one."""
    rng = random.Random(2)
    own = [(s, s + rng.randint(5, 40)) for s in (rng.randint(1, 560) for _ in range(45))]
    depth = defaultdict(int)
    for s, e in own:
        for p in range(s, e + 1):
            depth[p] += 1
    reads = [(region, s, e) for region in (None, 4) for s, e in own] + [(4, s, None) for s in range(50)] + [(4, None, 90)] * 30
    runs = intervals.depth(spark.createDataFrame(reads, "region long, start long, end long"), ["region"], 64)
    found = factories.low_coverage_cuts(spark.createDataFrame([(None, 600), (4, 600)], "region long, length long"), runs, 50, 7, 40, 15, 2)
    wanted = looped_cuts(depth, 600, 50, 7, 40, 15, 2)
    assert sorted(map(tuple, found.filter("region = 4").collect())) == sorted((4, *x) for x in wanted) and len(wanted) > 1
    assert sorted(map(tuple, found.filter("region IS NULL").select("start", "end").collect())) == sorted(wanted)


@pytest.mark.parametrize("size", [1, 7, 64])
def test_fetched_parts(spark, size):
    rng = random.Random(size)
    seqs = {i: "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate([1, 7, 14, 50, 200])}
    turn = str.maketrans("ACGT", "TGCA")
    regions = [(f"{i}-{k}", i, a, a + rng.randint(0, 80), rng.choice([1, -1])) for i, s in seqs.items() for k in range(20) for a in [rng.randint(-3, len(s) + 3)]]
    regions += [("none", 99, 1, 5, 1), ("empty", 3, 9, 3, 1)]
    chunks = sequences.chunked(spark.createDataFrame([*seqs.items(), (50, None), (51, "")], "seq_id long, seq string"), size)
    found = sequences.fetched(spark.createDataFrame(regions, "region_id string, seq_id long, start long, end long, strand int"), chunks, size)
    got = {r["region_id"]: r["seq"] for r in found.collect()}
    for name, i, a, b, strand in regions:
        part = seqs.get(i, "")[max(a, 1) - 1 : max(b, 0)]
        assert got[name] == ((part if strand == 1 else part.translate(turn)[::-1]) or None)


NET = """# a comment
net chr1 5000
 fill 100 900 chr2 + 200 800 id 1 score 500.5 ali 700 type top
  gap 300 50 chr2 + 400 0
   fill 310 30 chr3 - 7 31 id 2 score 9 ali 20
  gap 500 60 chr2 + 600 10
   fill 505 20 chr9 + 1 20 id 4
    gap 510 2 chr9 + 6 0
   fill 530 20 chr9 + 50 20 id 5
 fill 2000 10 chr5 + 1 10 id 3

net chr2 100
 fill 1 50 chr1 + 1 50 id 6 type syn
"""


@pytest.mark.parametrize("split", [None, 40, 90])
def test_net_files(spark, tmp_path, split):
    for name in ("a", "b"):
        (tmp_path / f"{name}.net").write_text(NET)
    lines = [x for x in NET.splitlines() if x.strip() and not x.startswith("#")]
    stack, wanted, net = [], [], None
    for i, x in enumerate(lines):
        depth = len(x) - len(x.lstrip(" "))
        stack = [*stack[:depth], i]
        f = x.split()
        net = f[1] if f[0] == "net" else net
        wanted.append((f[0], net, int(f[2]), depth, stack[depth - 1] if depth else None, f[3] if depth else None))
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = formats.read_net(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name in ("a", "b"):
        own = sorted((r for r in rows if r["file"].endswith(f"{name}.net")), key=lambda r: (r["block"], r["line"]))
        number = {(r["block"], r["line"]): i for i, r in enumerate(own)}
        assert [(r["kind"], r["target"], r["size"], r["depth"], number.get((r["parent_block"], r["parent_line"])), r["query"]) for r in own] == wanted
        assert own[1]["attributes"] == {"id": "1", "score": "500.5", "ali": "700", "type": "top"} and own[2]["attributes"] == {} and own[0]["attributes"] is None
    if split:
        assert len({r["block"] for r in rows}) > 2


def test_chains_of_two_files(spark, tmp_path):
    for name, gap in (("a", 5), ("b", 9)):
        (tmp_path / f"{name}.chain").write_text(f"chain 100 chr1 500 + 10 60 chrX 400 + 20 70 1\n10 {gap} 3\n20\n\n")
    found = formats.read_chain(spark, str(tmp_path)).collect()
    assert sorted((r["target_start"], r["query_start"], r["length"]) for r in found) == [(10, 20, 10), (10, 20, 10), (25, 33, 20), (29, 33, 20)]
    assert F is not None
