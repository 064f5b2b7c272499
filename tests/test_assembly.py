"""Searches through exon and intron graphs against walks of every path, on random graphs and through the registered queries."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strandline import queries
from strandline.operators import assembly, intervals
from strandline.plans import assembly_queries
from strandline.sources import driver_tables as t

SF = "/root/testdata/sf0.001"


def pieces_of(n, steps):
    root = list(range(n))
    for i, _, j in steps:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def every_model(exons, introns, out, into, k, pad):
    """All maximal paths, those with an impossible exon left out, k for each connected piece."""
    steps = [(i, t, j) for i in out for t in out[i] for j in into.get(t, ())]
    root, entered, left = pieces_of(len(exons), steps), {s[2] for s in steps}, {s[0] for s in steps}
    found = defaultdict(list)

    def walk(path):
        if path[-1] not in left:
            if len(path) > 1:
                own, used = path[::2], path[1::2]
                starts = [exons[own[0]][0] + pad, *[introns[t][1] for t in used]]
                ends = [*[introns[t][0] for t in used], exons[own[-1]][1] - pad]
                if all(e > s for s, e in zip(starts, ends)):
                    score = sum(exons[i][2] for i in own) / 100 + sum(introns[t][2] for t in used)
                    found[root[own[0]]].append((-round(score, 6), tuple(path), starts, ends))
            return
        for i, t, j in steps:
            if i == path[-1]:
                walk([*path, t, j])

    for i in range(len(exons)):
        if i not in entered:
            walk([i])
    return [(p, n, -x[0], x[2], x[3]) for p in sorted(found) for n, x in enumerate(sorted(found[p])[:k], 1)]


def random_graph(rng, n):
    exons = sorted((s, s + rng.randint(4, 40), 100 * rng.randint(0, 3)) for s in (rng.randint(1, 400) for _ in range(n)))
    introns = sorted({(a[1] - rng.randint(0, 3), b[0] + rng.randint(0, 3)) for a in exons for b in exons if b[0] > a[1] + 4 and rng.random() < 0.3})
    introns = [(s, e, rng.randint(1, 5)) for s, e in introns]
    out = {i: [t for t, x in enumerate(introns) if a[0] <= x[0] <= a[1] < x[1]] for i, a in enumerate(exons)}
    into = {t: [j for j, b in enumerate(exons) if x[0] < b[0] <= x[1] <= b[1]] for t, x in enumerate(introns)}
    return exons, introns, out, {t: j for t, j in into.items() if j}


@pytest.mark.parametrize("seed", range(25))
def test_best_paths_equal_all_paths(seed):
    rng = random.Random(seed)
    exons, introns, out, into = random_graph(rng, rng.randint(1, 9))
    for k, pad in ((1, 0), (4, 2)):
        found = [(p, n, round(s, 6), a, b) for p, n, s, a, b in assembly.best_paths(exons, introns, out, into, k, pad)]
        assert found == every_model(exons, introns, out, into, k, pad)


def test_a_graph_with_a_million_paths_ends():
    # twenty stages of two exons each, every one joined to both of the next: 2 ** 20 paths
    exons = [(100 * i + 10 * b, 100 * i + 10 * b + 40, 100.0) for i in range(21) for b in range(2)]
    introns = [(100 * i + 38 + b, 100 * i + 112 + c, 1.0 + b + c) for i in range(20) for b in range(2) for c in range(2)]
    out = {2 * i + b: [4 * i + 2 * b + c for c in range(2)] for i in range(20) for b in range(2)}
    into = {4 * i + 2 * b + c: [2 * i + 2 + c] for i in range(20) for b in range(2) for c in range(2)}
    found = assembly.best_paths(exons, introns, out, into, 3, 0)
    assert [x[1] for x in found] == [1, 2, 3] and found[0][2] == pytest.approx(21 + 20 * 3)
    kept = assembly.thinned(42, out, into, [x[2] for x in introns], [False] * 42, 10_000)
    assert max(assembly._walks(kept, into, 42)) <= 10_000
    assert assembly.thinned(42, out, into, [x[2] for x in introns], [False] * 42, 10**9) == out


def test_thinning_takes_the_weakest():
    out, into = {0: [0, 1, 2], 1: [3]}, {0: [1], 1: [1], 2: [1], 3: [2]}
    assert assembly._walks(out, into, 3) == [12, 2, 0]
    assert assembly.thinned(3, out, into, [5.0, 1.0, 3.0, 1.0], [False] * 3, 8) == {0: [0, 2], 1: [3]}
    assert assembly.thinned(3, out, into, [5.0, 1.0, 3.0, 1.0], [True, False, False], 8) == {1: [3]}


def test_retained_introns_split_exons(spark):
    exons = spark.createDataFrame([(1, 1, s, 1, 100, 4.0) for s in (-1, 1)], "gene_id long, region long, strand int, start long, end long, score double")
    introns = spark.createDataFrame([(1, 1, 20, 60, 2.0, True), (1, 1, 30, 61, 9.0, False), (1, -1, 40, 50, 3.0, True)], "region long, strand int, start long, end long, score double, canonical boolean")
    found = assembly.retained_pieces(exons, introns, ["region"], 2)
    # 20-60 falls short of the penalty, 30-61 has it twice
    assert sorted((r["strand"], r["start"], r["end"]) for r in found.collect()) == [(-1, 1, 43), (-1, 47, 100), (1, 1, 43), (1, 48, 100)]


def plain_edges(exons, introns, strict):
    """side, exon, intron of every link, for exons and introns of one gene and strand."""
    found = set()
    for s, e in exons:
        side = {"left": [], "right": []}
        for x in introns:
            a, b, score, canonical = x
            if b < s or a > e or (a > s and b < e) or (a < s and b > e) or not (canonical or score > 1):
                continue
            if b <= e:
                side["left"].append(x)
            if a >= s:
                side["right"].append(x)
        for name, own in side.items():
            place = 1 if name == "left" else 0
            if strict and all(side.values()):
                best = min(own, key=lambda x: (-x[2], x[place]))[place]
                own = [x for x in own if x[place] == best]
            elif any(x[3] for x in own):
                own = [x for x in own if x[3]]
            found |= {(name, s, e, x[0], x[1]) for x in own if (x[0] < s if name == "left" else x[1] > e)}
    return found


@pytest.mark.parametrize("strict", [True, False])
def test_splice_edges(spark, strict):
    rng = random.Random(2)
    exons = {g: sorted({(s, s + rng.randint(5, 30)) for s in (rng.randint(1, 200) for _ in range(6))}) for g in range(12)}
    introns = {g: sorted({(s, s + rng.randint(5, 60)) for s in (rng.randint(1, 200) for _ in range(25))}) for g in range(12)}
    introns = {g: [(*x, float(rng.randint(1, 4)), rng.random() < 0.6) for x in own] for g, own in introns.items()}
    left = spark.createDataFrame([(g, g, 1, s, e, 1.0) for g, own in exons.items() for s, e in own], "gene_id long, region long, strand int, start long, end long, score double")
    right = spark.createDataFrame([(g, 1, *x) for g, own in introns.items() for x in own], "region long, strand int, start long, end long, score double, canonical boolean")
    found = assembly.splice_edges(left, right, ["region"], strict).select("gene_id", "side", "start", "end", "r_start", "r_end").collect()
    assert sorted(map(tuple, found)) == sorted((g, *x) for g in exons for x in plain_edges(exons[g], introns[g], strict))


def test_refined_query(spark):
    """The registered query, from its rough models and introns, by a walk of all paths."""
    rough = defaultdict(list)
    for r in t.exons(spark, SF).select("gene_id", "region", "start", "end", F.floor(F.col("score") / 100).alias("score")).collect():
        rough[r["gene_id"], r["region"]].append((r["start"], r["end"], float(r["score"])))
    reads = defaultdict(list)
    for r in assembly_queries.reads_introns(spark, SF).collect():
        if 5 < r["end"] - r["start"] + 1 <= 200_000:
            reads[r["region"], r["strand"]].append((r["start"], r["end"], r["score"], r["canonical"]))
    wanted = []
    for (gene, region), own in rough.items():
        if sum(e - s + 1 for s, e, _ in own) < 60:
            continue
        for strand in (-1, 1):
            exons, level = set(own), set(own)
            while level:
                pieces = set()
                for s, e, score in level:
                    held = sorted(x for x in reads[region, strand] if x[0] > s and x[1] < e and x[2] - (2 if x[3] else 4) >= 1)
                    if held:
                        a, b = held[0][:2]
                        half = (b - a) // 2
                        pieces |= {p for p in ((s, a + half - 2, score), (b - half + 2, e, score)) if p[0] <= p[1]}
                level = {p for p in pieces if p[:2] not in {x[:2] for x in exons}}
                exons |= level
            exons = sorted(exons)
            edges = plain_edges([x[:2] for x in exons], reads[region, strand], True)
            score = {x[:2]: x[2] for x in reads[region, strand]}
            names = sorted({x[3:] for x in edges})
            used = [i for i, x in enumerate(exons) if any(y[1:3] == x[:2] for y in edges)]
            exons = [exons[i] for i in used]
            out = {i: [names.index(y[3:]) for y in sorted(edges) if y[0] == "right" and y[1:3] == x[:2]] for i, x in enumerate(exons)}
            into = defaultdict(list)
            for j, x in enumerate(exons):
                for y in edges:
                    if y[0] == "left" and y[1:3] == x[:2]:
                        into[names.index(y[3:])].append(j)
            wanted += [(gene, strand, *x) for x in every_model(exons, [(*n, score[n]) for n in names], out, into, 3, 2)]
    found = [(r["gene_id"], r["strand"], r["piece"], r["place"], r["score"], list(r["starts"]), list(r["ends"])) for r in queries.QUERIES["refined_models"](spark, SF).collect()]
    assert len(wanted) > 50 and sorted((*x[:4], round(x[4], 4), *x[5:]) for x in found) == sorted((*x[:4], round(x[4], 4), *x[5:]) for x in wanted)


def every_chain(exons, introns, utr):
    best = None

    def walk(path, score):
        nonlocal best
        if path[-1][0] == "last":
            best = min(best or (0, ()), (-score, tuple(x[1:3] for x in path))) if best else (-score, tuple(x[1:3] for x in path))
            return
        for (s, e), gain in introns.items():
            if s == path[-1][2] + 1:
                for x in exons:
                    if x[0] != "first" and x[1] == e + 1:
                        walk([*path, x], score + gain + x[4] - 2 * utr * x[3])

    for x in exons:
        if x[0] == "first":
            walk([x], x[4] - utr * x[3])
    return best


@pytest.mark.parametrize("seed", range(20))
def test_best_chain_equals_all_chains(seed):
    rng = random.Random(seed)
    exons = list({(role, 10 * i, 10 * i + rng.choice([4, 6])): (rng.randint(0, 1), rng.randint(-2, 8) / 4) for i in range(7) for role in rng.sample(["first", "inner", "last"], 2)}.items())
    exons = [(*k, *v) for k, v in exons]
    introns = {(10 * i + d + 1, 10 * j - 1): rng.randint(-2, 6) / 4 for i in range(7) for d in (4, 6) for j in range(i + 1, 7) if rng.random() < 0.5}
    found, wanted = assembly.best_chain(exons, introns, 0.25), every_chain(exons, introns, 0.25)
    assert (found is None) == (wanted is None)
    if found:
        assert found[0] == pytest.approx(-wanted[0]) and list(zip(found[1], found[2])) == [tuple(x) for x in wanted[1]]


def plain_consensus(models, spans, least=1.0, utr=0.2, end=0.5, est=0.2, short_intron=50, short_exon=15):
    """models of one cluster: (exons, is_est); spans: those of all models with several exons on the strand."""
    n, ests = len(models), sum(m[1] for m in models)

    def quotient(total, own, all_models, all_ests):
        plain = total / (least + all_models)
        return (own / (least + all_ests) + plain) / 2 if own else plain - (est if least + all_ests > 1.5 else 0)

    same, same_est, ends, introns, nodes = Counter(), Counter(), defaultdict(list), defaultdict(list), set()
    for exons, is_est in models:
        for i, x in enumerate(exons):
            role = "inner" if len(exons) == 1 or 0 < i < len(exons) - 1 else "first" if i == 0 else "last"
            same[x] += 1
            same_est[x] += is_est
            nodes.add((role, *x))
            if role != "inner":
                ends[role, x[1] if role == "first" else x[0]].append((x[1] - x[0] + 1, is_est))
            if i:
                introns[exons[i - 1][1] + 1, x[0] - 1].append(is_est)
    scored = []
    for role, s, e in nodes:
        length = e - s + 1
        if role == "inner":
            score = quotient(same[s, e], same_est[s, e], n, ests) - (0.5 if length < short_exon else 0)
        else:
            own = ends[role, e if role == "first" else s]
            score, share = quotient(len(own), sum(x[1] for x in own), n, ests), length / max(x[0] for x in own)
            score = (score * share if score >= 0 else score / share) - end
        scored.append((role, s, e, int(same_est[s, e] == same[s, e]), score))
    joined = {}
    for (s, e), own in introns.items():
        over = [x for x in spans if x[0] <= e and s <= x[1]]
        joined[s, e] = quotient(len(own), sum(own), len(over), sum(x[2] for x in over)) - (0.5 if e - s + 1 < short_intron else 0)
    return every_chain(scored, joined, utr)


def test_consensus_query(spark):
    models, place = defaultdict(list), {}
    for r in t.exons(spark, SF).collect():
        models[r["gene_id"]].append((r["start"], r["end"]))
        place[r["gene_id"]] = (r["region"], r["strand"], r["source"] == "O")
    models = {g: sorted(x) for g, x in models.items()}
    spans = defaultdict(list)
    for g, x in models.items():
        if len(x) > 1:
            spans[place[g][:2]].append((x[0][0], x[-1][1], place[g][2]))
    clusters = defaultdict(list)
    for r in queries.QUERIES["exon_overlap_clusters"](spark, SF).collect():
        clusters[r["cluster"]].append(r["gene_id"])
    wanted = {}
    for c, own in clusters.items():
        if not all(place[g][2] for g in own):
            best = plain_consensus([(models[g], place[g][2]) for g in own], spans[place[own[0]][:2]])
            if best:
                wanted[c] = (round(-best[0], 5), [tuple(x) for x in best[1]])
    found = {r["cluster"]: (round(r["score"], 5), list(zip(r["starts"], r["ends"]))) for r in queries.QUERIES["consensus_models"](spark, SF).collect()}
    assert found.keys() == wanted.keys() and len(found) > 50
    for c in found:
        assert found[c][0] == pytest.approx(wanted[c][0], abs=2e-5)
    assert sum(found[c][1] == wanted[c][1] for c in found) > 0.98 * len(found)  # equal sums may differ in the last bit


def plain_contained(models):
    rank = sorted(models, key=lambda m: (-len(models[m]), -sum(e - s + 1 for s, e in models[m]), m))
    held = lambda a, b: b[0][0] <= a[0][0] and b[-1][1] >= a[-1][1] and all(any(x <= e and s <= y for x, y in b) for s, e in a)
    return {m: models[m] for i, m in enumerate(rank) if not any(held(models[m], models[b]) for b in rank[:i])}


def plain_continued(models):
    def whole(name):
        exons = models[name]
        ways = [(-(len(x) - 1 - i), g, i) for g, x in models.items() for i in range(1, len(x) - 1) if len(exons) > 1 and (x[i - 1][1], x[i][0]) == (exons[-2][1], exons[-1][0])]
        if not ways:
            return exons
        _, g, i = min(ways)
        return [*exons[:-1], *whole(g)[i:]]

    return {g: whole(g) for g in models}


def random_models(rng, n):
    grid = [(20 * i, 20 * i + 8) for i in range(12)]
    out = {}
    for g in range(n):
        a = rng.randint(0, 10)
        own = [x for x in grid[a : a + rng.randint(1, 6)] if rng.random() < 0.85] or [grid[a]]
        out[g] = [(own[0][0] + rng.randint(0, 3), own[0][1]), *own[1:]] if len(own) > 1 else own
        out[g] = [*out[g][:-1], (out[g][-1][0], out[g][-1][1] - rng.randint(0, 3))]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_coalescing_rules(seed):
    models = random_models(random.Random(seed), 14)
    assert assembly.continued(list(models.items())) == plain_continued(models)
    assert assembly.not_contained(models) == plain_contained(models)


def test_coalesced_models(spark):
    rng = random.Random(77)
    rows, wanted = [], []
    for region in range(15):
        models = {100 * region + g: x for g, x in random_models(rng, 10).items()}
        rows += [(g, region, 1, s, e) for g, x in models.items() for s, e in x]
        root = {g: g for g in models}
        for a in models:
            for b in models:
                if any(s <= y and x <= e for s, e in models[a] for x, y in models[b]):
                    low, high = sorted((root[a], root[b]))
                    root = {g: low if r == high else r for g, r in root.items()}
        for c in set(root.values()):
            own = plain_continued({g: models[g] for g in models if root[g] == c})
            mirror = plain_continued({g: [(-e, -s) for s, e in reversed(x)] for g, x in own.items()})
            first = {}
            for g, x in sorted(mirror.items()):
                first.setdefault(tuple((-e, -s) for s, e in reversed(x)), g)
            wanted += [(g, c, *map(list, zip(*x))) for g, x in plain_contained({g: list(x) for x, g in first.items()}).items()]
    frame = spark.createDataFrame(rows, "gene_id long, region long, strand int, start long, end long")
    found = [(r["gene_id"], r["cluster"], list(r["starts"]), list(r["ends"])) for r in assembly.coalesced_models(frame, ["region", "strand"]).collect()]
    assert sorted(found) == sorted(wanted)


def test_coalesced_query(spark):
    models = defaultdict(list)
    for r in t.exons(spark, SF).collect():
        models[r["gene_id"]].append((r["start"], r["end"]))
    found = queries.QUERIES["coalesced_models"](spark, SF).collect()
    assert {r["gene_id"] for r in found} <= set(models) and all(len(r["starts"]) >= 1 for r in found)
    exons = {x for own in models.values() for x in own}
    # every model lies inside one that is left
    left = defaultdict(list)
    for r in found:
        assert set(list(zip(r["starts"], r["ends"]))[1:-1]) <= exons
        left[r["cluster"]].append(list(zip(r["starts"], r["ends"])))
    clusters = {r["gene_id"]: r["cluster"] for r in queries.QUERIES["exon_overlap_clusters"](spark, SF).collect()}
    for g, x in models.items():
        assert any(min(x)[0] >= y[0][0] and max(x)[1] <= y[-1][1] for y in left[clusters[g]])


def test_overlap_sums(spark):
    rng = random.Random(4)
    left = [(i, rng.randint(0, 1), a, a + rng.randint(0, 50)) for i, a in enumerate(rng.randint(1, 300) for _ in range(60))]
    right = [(rng.randint(0, 1), a, a + rng.randint(0, 80), float(rng.randint(0, 3))) for a in (rng.randint(1, 300) for _ in range(80))]
    frames = spark.createDataFrame(left, "id long, k int, start long, end long"), spark.createDataFrame(right, "k int, start long, end long, w double")
    found = intervals.overlap_sums(*frames, ["k"], ["id"], ["w"], scan_bin=32)
    wanted = {i: sum(w for k2, x, y, w in right if k == k2 and x <= e and s <= y) for i, k, s, e in left}
    assert {r["id"]: r["w"] for r in found.collect()} == wanted


def test_refined_models_need_one_pass(spark):
    """Pairs of exons and introns travel once: no job runs before the result is asked for, however often exons are cut."""
    exons = spark.createDataFrame([(1, 1, 1, 400, 9.0), (1, 1, 500, 600, 9.0)], "gene_id long, region long, start long, end long, score double")
    introns = [(1, 1, 100, 300, 9.0, True), (1, 1, 20, 60, 9.0, True), (1, 1, 395, 505, 9.0, True)]
    introns = spark.createDataFrame(introns, "region long, strand int, start long, end long, score double, canonical boolean")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("refined", "refined")
    found = assembly.refined_models(exons, introns, ["region"], shortest_model=1, min_intron=5, penalty=2, k=2, pad=2)
    assert not tracker.getJobIdsForGroup("refined")
    # 1-400 is cut at 20-60, then the rest at 100-300
    rows = sorted((r["place"], r["strand"], list(r["starts"]), list(r["ends"])) for r in found.collect())
    assert rows[0][1:] == (1, [3, 60, 300, 505], [20, 100, 395, 598])


def shuffled(spark, job):
    """What job gives, and the bytes that its stages wrote for shuffles."""
    context = spark.sparkContext

    def total():
        context._jsc.sc().listenerBus().waitUntilEmpty()
        stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    return job(), total() - before


def test_consensus_models_are_moved_as_wholes(spark):
    place = "abs(hash(id div 4)) % 9000 + id % 4 * 100"
    exons = spark.range(40_000).selectExpr("id div 4 AS gene_id", "id div 400 AS region", "1 AS strand", f"{place} AS start", f"{place} + 20 + id % 17 AS end", "id div 4 % 3 = 0 AS is_est")
    found, moved = shuffled(spark, lambda: sorted(tuple(r) for r in assembly.consensus_models(exons, ["region", "strand"], short_exon=30).collect()))
    assert len(found) > 400 and moved < 110 * 40_000
    # clusters that are too large for one task are scored before they are searched
    large = sorted(tuple(r) for r in assembly.consensus_models(exons, ["region", "strand"], short_exon=30, most=2).collect())
    assert [(r[0], *r[2:]) for r in large] == [(r[0], *r[2:]) for r in found] and [r[1] for r in large] == pytest.approx([r[1] for r in found], abs=2e-6)


def test_exons_without_a_place_make_no_consensus(spark):
    rows = [(1, 1, 1, 1, 50, False), (1, 1, 1, 101, 150, False), (1, 1, 1, None, 170, False), (1, 1, 1, 180, None, False), (2, None, 1, 1, 50, False), (2, None, 1, 101, 150, False), (None, 1, 1, 1, 50, False), (3, 1, -1, 1, 50, None), (3, 1, -1, 101, 150, None), (4, 2, 1, 1, 50, None), (4, 2, 1, 101, 150, None), (5, 2, 1, 1, 50, False)]
    exons = spark.createDataFrame(rows, "gene_id long, region long, strand int, start long, end long, is_est boolean")
    for most in (0, 10):
        found = assembly.consensus_models(exons, ["region", "strand"], most=most).collect()
        assert sorted((r["cluster"], r["starts"], r["ends"]) for r in found) == [(1, [1, 101], [50, 150]), (4, [1, 101], [50, 150])]
