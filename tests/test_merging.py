"""Planted classes of matches, and untranslated exons against the rule read as a loop over layers and donors."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandline import queries
from strandline.operators import merging
from strandline.plans import merging_queries

SF = "/root/testdata/sf0.001"
SCHEMA = "gene_id long, locus long, manual boolean, exons array<struct<rank:int,start:long,end:long>>, cds_start long, cds_end long, complete boolean, listed boolean, small boolean"


def model(gene, locus, manual, exons, cds=(None, None), complete=True, listed=False, small=False):
    return gene, locus, manual, [(i + 1, s, e) for i, (s, e) in enumerate(exons)], *cds, complete, listed, small


THREE = [(100, 150), (200, 250), (300, 350)]
OTHER = [(100, 150), (200, 240), (300, 350)]
LONGER = [(80, 150), (200, 250), (300, 380)]


@pytest.mark.parametrize(
    ("auto", "manual", "wanted"),
    [
        (model(1, 1, False, THREE), model(2, 1, True, LONGER), "replaced"),  # neither coding, equal introns
        (model(1, 1, False, THREE), model(2, 1, True, OTHER), None),
        (model(1, 1, False, THREE), model(2, 1, True, THREE[:2]), None),
        (model(1, 1, False, THREE), model(2, 2, True, THREE), None),  # another locus
        (model(1, 1, False, [(5, 20)]), model(2, 1, True, [(5, 20)]), "replaced"),
        (model(1, 1, False, [(5, 20)]), model(2, 1, True, [(6, 21)]), None),
        (model(1, 1, False, [(5, 20)], small=True), model(2, 1, True, [(6, 21)]), "kept"),
        (model(1, 1, False, [(5, 20)], small=True), model(2, 1, True, [(5, 21)]), None),
        (model(1, 1, False, LONGER), model(2, 1, True, THREE, (110, 340)), "replaced"),  # the manual one coding throughout
        (model(1, 1, False, LONGER), model(2, 1, True, THREE, (210, 240)), None),
        (model(1, 1, False, [(5, 20)]), model(2, 1, True, [(1, 30)], (5, 20)), "replaced"),
        (model(1, 1, False, THREE, ), model(2, 1, True, THREE, (90, 360)), "replaced"),
        (model(1, 1, False, THREE, (110, 340)), model(2, 1, True, LONGER), "replaced"),  # only the automatic one coding
        (model(1, 1, False, THREE, (110, 340), listed=True), model(2, 1, True, LONGER), None),
        (model(1, 1, False, [(5, 20)], (5, 20)), model(2, 1, True, [(50, 60)]), "replaced"),
        (model(1, 1, False, THREE, (110, 340), complete=False), model(2, 1, True, OTHER), "incomplete"),
        (model(1, 1, False, THREE, (110, 340), complete=False), model(2, 1, True, THREE[:2]), None),
        (model(1, 1, False, THREE, (110, 340), complete=False, listed=True), model(2, 1, True, LONGER, (110, 340)), "replaced"),
        (model(1, 1, False, THREE, (110, 340)), model(2, 1, True, LONGER, (110, 340)), "replaced"),
        (model(1, 1, False, THREE, (110, 340)), model(2, 1, True, LONGER, (111, 340)), None),
        (model(1, 1, False, THREE, (110, 340)), model(2, 1, True, OTHER, (110, 340)), None),  # inner coding exons differ
        (model(1, 1, False, [(10, 20), *THREE], (110, 340)), model(2, 1, True, [(10, 25), *THREE], (110, 340)), "variant"),
        (model(1, 1, False, [(5, 20)], (5, 20)), model(2, 1, True, [(1, 30)], (5, 20)), "replaced"),
        (model(1, 1, False, [(5, 20)], (8, 16)), model(2, 1, True, [(5, 20)], (8, 16)), "replaced"),
        (model(1, 1, False, [(5, 20)], (8, 16)), model(2, 1, True, [(1, 30)], (8, 16)), "kept"),
        (model(1, 1, False, [(5, 20)], (8, 16)), model(2, 1, True, [(1, 30)], (8, 17)), None),
    ],
)
def test_relations(spark, auto, manual, wanted):
    found = merging.matched_models(spark.createDataFrame([auto, manual], SCHEMA), ["locus"]).collect()
    assert [(r["auto_id"], r["relation"], r["manual_id"]) for r in found] == ([(1, wanted, 2)] if wanted else [])


def test_merged_set_moves_evidence(spark):
    rows = [
        model(1, 1, False, THREE, (110, 340)), model(2, 1, True, LONGER, (110, 340)), model(3, 1, True, THREE, (110, 340)),  # 1 goes to 2
        model(4, 2, False, [(5, 20)], (8, 16)), model(5, 2, True, [(1, 30)], (8, 16)),  # 5 goes to 4
        model(6, 3, False, THREE), model(7, 3, True, OTHER), model(8, 4, False, THREE, (110, 340), complete=False), model(9, 4, True, OTHER),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    evidence = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (5, 12), (4, 12), (5, 13), (6, 14), (8, 15)], "gene_id long, hit long")
    found = merging.merged_set(frame, merging.matched_models(frame, ["locus"]), evidence)
    wanted = [(2, "merged", 2), (3, "manual", 0), (4, "merged", 2), (6, "automatic", 1), (7, "manual", 0), (9, "manual", 0)]
    assert sorted(map(tuple, found.collect())) == wanted


def introns_of(exons):
    return [(a[1] + 1, b[0] - 1) for a, b in zip(exons, exons[1:])]


def looped_utr(exons, donors, longest=10_000):
    """low donor, high donor, new exons of an acceptor with introns; donors: (priority, id, exons)."""
    own = introns_of(exons)
    layers = defaultdict(list)
    for priority, name, d in donors:
        theirs = introns_of(d)
        shared = set(own) & set(theirs)
        if theirs:
            layers[priority].append((len(shared), own[0] in shared, own[-1] in shared, name, d))

    def low_end(d):
        part = [x for x in d if x[1] <= exons[0][1]]
        return part if part[-1][0] < exons[0][0] and (len(part) > 1 or exons[0][0] - part[0][0] <= longest) else None

    def high_end(d):
        part = [x for x in d if x[0] >= exons[-1][0]]
        return part if part[0][1] > exons[-1][1] and (len(part) > 1 or part[-1][1] - exons[-1][1] <= longest) else None

    size = lambda part, x: (len(part), sum(e - s + 1 for s, e in part) - (x[1] - x[0] + 1))
    low = high = both = None  # (score, layer, exons, bases, donor, part)
    for priority in sorted(layers):
        for score, meets_low, meets_high, name, d in sorted(layers[priority], key=lambda x: (-x[0], not (x[1] or x[2]), x[3])):
            if not meets_low and not meets_high or both and score < both[0] or low and high and score < low[0] and score < high[0]:
                break
            a, b = low_end(d) if meets_low else None, high_end(d) if meets_high else None
            if a and b and (low is None or priority <= low[1]) and (high is None or priority <= high[1]):
                (na, la), (nb, lb) = size(a, exons[0]), size(b, exons[-1])
                way = (score, priority, na + nb, la + lb, name, a, b)
                if both is None or (way[0], way[2], way[3], -name) > (both[0], both[2], both[3], -both[4]):
                    both = way
                continue
            if a and (low is None or priority == low[1]):
                n, bases = size(a, exons[0])
                if low is None or score == low[0] and (n, bases, -name) > (low[2], low[3], -low[4]):
                    low = (score, priority, n, bases, name, a)
            if b and (high is None or priority == high[1]):
                n, bases = size(b, exons[-1])
                if high is None or score == high[0] and (n, bases, -name) > (high[2], high[3], -high[4]):
                    high = (score, priority, n, bases, name, b)
        if both:
            low, high = (*both[:5], both[5]), (*both[:5], both[6])
            break
        if low and high:
            break
    grown = [*(low[5] if low else exons[:1]), *exons[1:-1], *(high[5] if high else exons[-1:])]
    return low and low[4], high and high[4], grown


def random_case(rng):
    grid = [(100 * i, 100 * i + 40) for i in range(2, 6)]
    acceptor = [(s, e + rng.choice([0, 0, 7])) for s, e in grid[: rng.randint(2, 4)]]
    donors = []
    for name in range(rng.randint(1, 6)):
        d = [(s, e + rng.choice([0, 0, 7])) if rng.random() < 0.5 else (s, e) for s, e in [(100, 130), *acceptor, (700, 740)]]
        d = d[rng.randint(0, 2) :][: rng.randint(1, 6)]
        d = [(d[0][0] - rng.randint(-3, 9), d[0][1]), *d[1:]]
        d = [*d[:-1], (d[-1][0], d[-1][1] + rng.randint(-3, 9))]
        donors.append((rng.randint(1, 3), name + 1, d))
    seen, kept = set(), []
    for p, name, d in donors:
        if (p, tuple(d)) not in seen:
            seen.add((p, tuple(d)))
            kept.append((p, name, d))
    return acceptor, kept


def test_utr_equals_the_loop(spark):
    rng = random.Random(12)
    cases = [random_case(rng) for _ in range(300)]
    rows = [(1000 * n, n, 1 if n % 2 else -1, [(1, s, e) for s, e in a], a[0][0], a[-1][1]) for n, (a, _) in enumerate(cases)]
    given = [(1000 * n + name, n, 1 if n % 2 else -1, p, [(1, s, e) for s, e in d]) for n, (_, donors) in enumerate(cases) for p, name, d in donors]
    kind = "array<struct<rank:int,start:long,end:long>>"
    found = merging.with_utr(
        spark.createDataFrame(rows, f"gene_id long, region int, strand int, exons {kind}, cds_start long, cds_end long"),
        spark.createDataFrame(given, f"gene_id long, region int, strand int, priority int, exons {kind}"), ["region", "strand"],
    )
    got = {r["gene_id"] // 1000: r for r in found.collect()}
    changed = 0
    for n, (a, donors) in enumerate(cases):
        low, high, grown = looped_utr(a, donors)
        r = got[n]
        assert (r["low_donor"] and r["low_donor"] - 1000 * n, r["high_donor"] and r["high_donor"] - 1000 * n, [tuple(x) for x in r["exons"]]) == (low, high, grown), (a, donors)
        before = sum(min(e, a[0][0] - 1) - s + 1 for s, e in grown if s < a[0][0])
        after = sum(e - max(s, a[-1][1] + 1) + 1 for s, e in grown if e > a[-1][1])
        assert (r["low_utr"], r["high_utr"], r["cds_in_cdna"]) == (before, after, (before if n % 2 else after) + 1)
        changed += low is not None or high is not None
    assert changed > 100


def test_single_exon_acceptors(spark):
    kind = "array<struct<rank:int,start:long,end:long>>"
    acceptors = [(1, 1, 1, [(1, 100, 200)], 110, 190), (2, 1, 1, [(1, 500, 600)], 500, 600)]
    donors = [(10, 1, 1, 2, [(1, 50, 300)]), (11, 1, 1, 1, [(1, 100, 210)]), (12, 1, 1, 1, [(1, 90, 205)]), (13, 1, 1, 1, [(1, 500, 600)]), (14, 1, 1, 1, [(1, 40, 220), (2, 300, 400)])]
    found = merging.with_utr(spark.createDataFrame(acceptors, f"gene_id long, region int, strand int, exons {kind}, cds_start long, cds_end long"), spark.createDataFrame(donors, f"gene_id long, region int, strand int, priority int, exons {kind}"), ["region", "strand"])
    got = {r["gene_id"]: (r["low_donor"], [tuple(x) for x in r["exons"]], r["low_utr"], r["high_utr"]) for r in found.collect()}
    assert got == {1: (12, [(90, 205)], 20, 15), 2: (None, [(500, 600)], 0, 0)}


def test_utr_query_equals_the_loop(spark):
    models = [r for r in merging_queries._models(spark, SF).collect()]
    spans = lambda r: sorted((e["start"], e["end"]) for e in r["exons"])
    donors, seen = defaultdict(list), set()
    for r in sorted((r for r in models if not r["manual"]), key=lambda r: r["gene_id"]):
        key = (r["region"], r["strand"], 1 if r["source"] == "O" else 2, tuple(spans(r)))
        if key not in seen:
            seen.add(key)
            donors[r["region"], r["strand"]].append((key[2], r["gene_id"], spans(r)))
    got = {r["gene_id"]: r for r in queries.QUERIES["utr_models"](spark, SF).collect()}
    changed = 0
    for r in models:
        if r["manual"] and r["cds_start"] is not None:
            own = [(max(s, r["cds_start"]), min(e, r["cds_end"])) for s, e in spans(r) if s <= r["cds_end"] and e >= r["cds_start"]]
            if len(own) > 1:
                low, high, grown = looped_utr(own, donors[r["region"], r["strand"]])
                f = got[r["gene_id"]]
                assert (f["low_donor"], f["high_donor"], f["n_exons"], f["start"], f["end"]) == (low, high, len(grown), grown[0][0], grown[-1][1])
                changed += low is not None or high is not None
    assert changed > 30 and F is not None
