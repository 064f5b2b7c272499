"""Sequential rules of curation and refinement on planted cases and against plain loops."""

import random

from pyspark.sql import functions as F

from strandline import queries
from strandline.operators import building, curation, ranking, refinement
from strandline.sources import driver_tables as t

SF = "/root/testdata/sf0.001"

MODEL = "gene_id long, region long, start long, end long, biotype string, place long, exons array<struct<start:long,end:long>>"


def models(spark, rows):
    made = [(g, r, own[0][0], own[-1][1], kind, place, [{"start": s, "end": e} for s, e in own]) for g, r, kind, place, own in rows]
    return spark.createDataFrame(made, MODEL).repartition(3)


def test_pruning_by_exon_pairs(spark):
    rows = [
        (1, 1, "a", 0, [(1, 10), (50, 60), (90, 99)]),
        (2, 1, "a", 1, [(5, 12), (55, 58)]),  # its pair overlaps one of 1
        (3, 1, "a", 2, [(5, 12), (70, 80)]),  # a pair of its own
        (4, 1, "a", 3, [(20, 24), (30, 40)]),  # an intron of 5: too short to be new
        (5, 1, "blessed", 4, [(2, 9), (51, 59)]),
        (6, 1, "a", 5, [(3, 8)]),  # a single exon beside models of several
        (7, 2, "a", 1, [(1, 10)]),
        (8, 2, "a", 0, [(1, 30)]),  # the longest of single exons
        (9, 2, "blessed", 2, [(20, 40)]),
    ]
    kept = curation.pruned_by_exon_pairs(models(spark, rows), ["region"], ["place"], ["blessed"], (2, 8))
    assert sorted(r["gene_id"] for r in kept.collect()) == [1, 3, 5, 8, 9]


def hits(rng, n):
    out = []
    for i in range(n):
        s = rng.randint(1, 400)
        out.append((i, rng.randint(1, 2), s, s + rng.randint(0, 60), f"h{rng.randint(0, 12)}", float(rng.randint(1, 9)), rng.choice([0.001, 0.5])))
    return out


HIT = "row_id long, region long, start long, end long, name string, score double, p_value double"


def plain_capped(rows, least, most_p, coverage):
    """row_ids kept of (row_id, start, end, name, score, p_value, strand) of one group, base by base."""
    names = {}
    for r in rows:
        names.setdefault(r[3], []).append(r)
    best = {n: max([r[4] for r in x if r[4] > least and (r[5] is None or r[5] < most_p)], default=0) for n, x in names.items()}
    total = {n: round(sum(r[4] for r in x if r[4] > least), 4) for n, x in names.items()}
    hits = {n: [r for r in x if r[4] <= best[n]] for n, x in names.items() if best[n] > 0}
    accepted = set()
    for strand in (1, -1):
        depth = {}
        for n in sorted(hits, key=lambda n: (-best[n], -total[n], n)):
            own = [r for r in hits[n] if r[6] == strand]
            if any(r[4] > least and r[5] is not None and r[5] < most_p and any(depth.get(p, 0) < coverage for p in range(r[1], r[2] + 1)) for r in own):
                accepted.add(n)
                for r in own:
                    for p in range(r[1], r[2] + 1):
                        depth[p] = depth.get(p, 0) + 1
    return {r[0] for n in accepted for r in hits[n]}


def test_hits_under_a_depth_cap(spark):
    rng = random.Random(3)
    for coverage, most in ((1, 400), (2, 400), (3, 4000)):
        rows = [(i, rng.randint(1, 2), s, s + rng.randint(0, 60), f"h{rng.randint(0, 12)}", float(rng.randint(1, 9)), rng.choice([0.001, 0.001, 0.5, None]), rng.choice([1, -1])) for i in range(160) for s in [rng.randint(1, most)]]
        found = refinement.capped_hits(spark.createDataFrame(rows, HIT + ", strand int").repartition(4), ["region"], "name", 4, 0.1, coverage, 64)
        wanted = set().union(*(plain_capped([(r[0], *r[2:]) for r in rows if r[1] == region], 4, 0.1, coverage) for region in (1, 2)))
        assert {r["row_id"] for r in found.collect()} == wanted and wanted


def test_a_hit_that_fails_makes_no_room(spark):
    # b's only passing hit lies under a, so b goes with its far, failing hit; c scores more where it fails
    rows = [(1, 1, 1, 100, "a", 50.0, 0.001, 1), (2, 1, 1, 100, "b", 40.0, 0.001, 1), (3, 1, 500, 600, "b", 1.0, 0.9, 1), (4, 1, 900, 950, "c", 30.0, 0.9, 1), (5, 1, 960, 970, "c", 20.0, 0.001, 1)]
    found = refinement.capped_hits(spark.createDataFrame(rows, HIT + ", strand int"), ["region"], "name", 10, 0.1, 1)
    assert sorted(r["row_id"] for r in found.collect()) == [1, 5]


def test_crowded_places_are_judged_by_islands_as_others_are_whole(spark):
    rng = random.Random(5)
    sizes = {1: 20, 2: 90, 3: 200}
    rows = [(i, region, s, s + rng.randint(0, 60), f"h{rng.randint(0, 30)}", float(rng.randint(1, 9)), rng.choice([0.001, 0.001, 0.5, None]), rng.choice([1, -1])) for region, n in sizes.items() for i in range(1000 * region, 1000 * region + n) for s in [rng.randint(1, 900)]]
    # hits without a strand or a base of their own go with their name; those without a place or a name go
    rows += [(1, 1, 5, 9, "h1", 5.0, 0.001, None), (2, 1, 9, 5, "alone", 9.0, 0.001, 1), (3, 1, None, 9, "h1", 5.0, 0.001, 1), (4, None, 5, 9, "h1", 5.0, 0.001, 1), (5, 1, 5, 9, None, 5.0, 0.001, 1)]
    for coverage, most in ((1, 0), (2, 60), (2, 1000), (300, 60)):
        wanted = set().union(*(plain_capped([(r[0], *r[2:]) for r in rows if r[1] == region and r[0] >= 1000], 4, 0.1, coverage) for region in sizes))
        names = {r[4] for r in rows if r[1] == 1 and r[0] in wanted}
        kept = refinement.capped_hits(spark.createDataFrame(rows, HIT + ", strand int").repartition(4), ["region"], "name", 4, 0.1, coverage, 64, most)
        found = {r["row_id"] for r in kept.collect()}
        assert found - {1, 3} == wanted and found & {1, 3} == ({1, 3} if "h1" in names else set())


def test_capped_hits_query(spark):
    rows = {}
    for i, r in enumerate(t.features(spark, SF).collect()):
        rows.setdefault(r["region"], []).append((i, r["start"], r["end"], r["hit"], r["score"], round(100 - r["identity"], 4), r["strand"]))
    found = {r["region"]: r for r in queries.QUERIES["capped_hits"](spark, SF).collect()}
    for region, own in rows.items():
        kept = plain_capped(own, 20000, 6.0, 2)
        assert (found[region]["hits"] if region in found else 0) == len(kept)
        if kept:
            assert found[region]["score"] == round(sum(r[4] for r in own if r[0] in kept), 2) and found[region]["names"] == len({r[3] for r in own if r[0] in kept})


def test_pruned_depth(spark):
    rng = random.Random(4)
    rows = hits(rng, 120)
    found = {r["row_id"] for r in refinement.pruned_depth(spark.createDataFrame(rows, HIT), ["region"], "row_id", 3, 64).collect()}
    wanted = set()
    for region in (1, 2):
        own = [r for r in rows if r[1] == region]
        while True:
            depth = {}
            for r in own:
                for p in range(r[2], r[3] + 1):
                    depth[p] = depth.get(p, 0) + 1
            most = max(depth.values())
            if most <= 3:
                break
            # islands are independent, so the first of the most covered bases of the whole region is one island's
            at = min(p for p, d in depth.items() if d == most)
            own.remove(min((r for r in own if r[2] <= at <= r[3]), key=lambda r: (r[5], -r[0])))
        wanted |= {r[0] for r in own}
    assert found == wanted


def test_domains_are_chosen_by_family_first(spark):
    rows = [(1, 1, 1, 10, "x", 5.0, 0.0), (2, 1, 5, 20, "x", 9.0, 0.0), (3, 1, 15, 30, "y", 10.0, 0.0), (4, 1, 40, 50, "x", 1.0, 0.0)]
    table = spark.createDataFrame(rows, HIT)
    # across families at once 3 beats 2 and 1 stays; by family 1 falls to 2 before 2 falls to 3
    assert sorted(r["row_id"] for r in ranking.non_overlapping(table, ["region"], "score", "row_id").collect()) == [1, 3, 4]
    assert sorted(r["row_id"] for r in ranking.domains(table, ["region"], "name", "score", "row_id").collect()) == [3, 4]


def test_poly_a_tails():
    body = "CGTCGTCGTCGTCGTCGTCGTCGT"
    assert refinement.clipped_tail(body, 20) == body
    assert refinement.clipped_tail(body + "A" * 15, 20) == body
    assert refinement.clipped_tail(body + "A" * 9 + "CG" + "A" * 12, 20) == body
    assert refinement.clipped_tail(body + "A" * 15 + "CG", 20) == body
    assert refinement.clipped_tail("A" * 30, 20) is None
    assert refinement.clipped_tail(None, 20) is None and refinement.clipped_tail("", 20) == ""
    assert refinement.clipped_tail(body + "AAAAC", 20) == body + "AAAAC"


def test_capped_by_value_keeps_ties(spark):
    rows = spark.createDataFrame([(1, v) for v in (1, 2, 2, 2, 3)], "family long, value long")
    assert sorted(r["value"] for r in ranking.capped_by_value(rows, ["family"], "value", 2).collect()) == [1, 2, 2, 2]


def test_runs_on_both_strands(spark):
    rows = [(1, 1, 10, 1, 1, 10), (2, 20, 30, 11, 1, 20), (3, 25, 28, 15, 1, 19), (4, 40, 50, 5, 1, 9)] + [(5, 1, 60, 30, -1, 40), (6, 5, 10, 20, -1, 25), (7, 65, 70, 10, -1, 15), (8, 90, 95, 12, -1, 14)]
    hits = spark.createDataFrame(rows, "row_id long, start long, end long, hit_start long, strand int, hit_end long").withColumn("protein", F.lit("p"))
    runs = {r["row_id"]: r["run"] for r in building.collinear_runs(hits, ["strand"], 15, "row_id", "strand").collect()}
    # 3 lies under 2 and is no gap after it; 7 is measured from the end of 5
    assert runs == {1: 1, 2: 1, 3: 2, 4: 3, 5: 1, 6: 2, 7: 2, 8: 3}
    lengths = spark.createDataFrame([("p", 100)], "protein string, length long")
    found = refinement.merged_hits(hits, ["strand", "protein"], 15, lengths, "protein", "strand")
    assert sorted((r["strand"], r["start"], r["end"], r["percent"]) for r in found.collect()) == [(-1, 1, 70, 23.0), (-1, 90, 95, 3.0), (1, 1, 30, 20.0), (1, 40, 50, 5.0)]


def test_protected_names_stay(spark):
    rows = [(1, 1, 1, 10, "a", 9.0, 0.0), (2, 1, 1, 10, "b", 8.0, 0.0), (3, 1, 1, 10, "c", 7.0, 0.0)]
    hits = spark.createDataFrame(rows, HIT).withColumn("identity", F.lit(99.0))
    keep = lambda safe: sorted(r["name"] for r in ranking.depth_capped(hits, ["region"], "name", "score", 1, 90, protected=safe).collect())
    assert keep(None) == ["a"] and keep(F.col("name") == "c") == ["a", "c"]


def test_an_island_of_many_hits_ends(spark):
    rows = spark.range(200_000).select(F.lit(1).alias("region"), F.lit(1).alias("strand"), (F.col("id") * 3).alias("start"), (F.col("id") * 3 + 5).alias("end"), F.col("id").alias("row_id"), (F.col("id") % 997).cast("double").alias("score"), F.concat(F.lit("n"), (F.col("id") % 5000).cast("string")).alias("name"), F.lit(0.001).alias("p_value"))
    kept = ranking.non_overlapping(rows, ["region"], "score", "row_id").count()
    assert 66_000 < kept <= 100_000
    assert refinement.capped_hits(rows, ["region"], "name", 4, 0.1, 1).count() > 0


def test_poly_t_heads():
    body = "CGTCGTCGGCGTCGTCGTCGCCGT"
    tail, head = body + "A" * 15, "T" * 15 + body
    assert refinement.clipped_ends(tail, 20)[1] == "tail" and refinement.clipped_ends(head, 20)[1] == "head"
    turn = str.maketrans("ACGT", "TGCA")
    for s in (tail, head, body, "T" * 9 + body + "A" * 12, "T" * 12 + body + "A" * 7):
        # what is clipped does not depend on the strand
        kept, end = refinement.clipped_ends(s, 20)
        turned, other = refinement.clipped_ends(s.translate(turn)[::-1], 20)
        assert kept == turned.translate(turn)[::-1] and {end, other} in ({None}, {"head", "tail"})
    assert refinement.clipped_ends(None, 20) == (None, None) and refinement.clipped_ends("A" * 18, 20) == ("A" * 18, None)
    assert refinement.clipped_ends("A" * 40, 20) == (None, "tail") and refinement.clipped_ends(body, 20) == (body, None)


def test_painted_hits(spark):
    rng = random.Random(14)
    rows = [(i, rng.randint(1, 2), s, s + rng.randint(0, 40), float(rng.randint(1, 9))) for i in range(120) for s in [rng.randint(1, 500)]]
    found = curation.painted(spark.createDataFrame(rows, "row_id long, region long, start long, end long, score double"), ["region"], "score", "row_id")
    got = {}
    for r in found.collect():
        for p in range(r["start"], r["end"] + 1):
            assert (r["region"], p) not in got
            got[r["region"], p] = r["row_id"]
    wanted = {}
    for i, region, s, e, score in sorted(rows, key=lambda r: (-r[4], r[0])):
        for p in range(s, e + 1):
            wanted.setdefault((region, p), i)
    assert got == wanted


def test_retrotransposed_by_all_evidence(spark, tmp_path):
    """The registered query takes weak evidence as well."""
    from strandline.plans.curation_queries import retrotransposed

    day = __import__("datetime").datetime(1996, 1, 1)
    lines = [(1, 7, 0, 1, 5.0, 1.0, 0.1, 0.08, "A", "F", day), (2, 7, 0, 1, 5.0, 1.0, 0.1, 0.08, "A", "F", day), (2, 8, 0, 2, 5.0, 1.0, 0.0, 0.0, "A", "F", day)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(1, 1, "F", 1.0, day, "1-URGENT"), (2, 100, "F", 1.0, day, "1-URGENT")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    assert [tuple(r) for r in retrotransposed(spark, str(tmp_path)).collect()] == [(1, 1)]
