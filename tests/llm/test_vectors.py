"""Vector operators against brute force on small rows with every odd case."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import hard_negatives, vector_codes


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (40, 64, 33), (65, 3, 65), (70, 70, 70), (33, 0, 4)])
def test_strassen_equals_plain_products(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    for leaf in (1, 4, 32):
        assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    common = [0.5, -0.25, 0.125, 0.75]
    out = [(i, [rng.choice([-1, 1, 1, 1]) * rng.randint(0, 6) / 4 for _ in range(4)], rng.choice([1, 1, 1, 2, 3])) for i in range(150)]
    out += [(i, common, rng.choice([1, 2])) for i in range(200, 260)]
    out += [(300, None, 1), (301, [1.0, None, 2.0, 0.0], 1), (302, [1.0, float("nan"), 0.0, 0.0], 1), (303, [float("inf"), 1.0, 0.0, 0.0], 2), (304, common, None), (None, common, 1)]
    out += [(310, [], 1), (311, [1.5], 2), (312, [0.1] * 9, 1), (320, [1.0, 1.0, 1.0, 1.0], 9)]
    return out


def brute_negatives(rows, scale=256):
    fine = [(i, [int(np.floor(scale * x)) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, va, la in fine:
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, v, lab in fine if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:5]:
            fits = [x for x in scored if x[2] != la and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize(("group", "lot"), [(2048, 8192), (3, 17)])
def test_mined_negatives(spark, rows, group, lot):
    # extra columns with the names that the operator uses inside
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<double>, label int, row int, bounds string, score double").repartition(3)
    found = hard_negatives.mined(frame, F.col("vec_id") % 10 == 0, anchors_a_group=group, lot=lot)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows)


def test_mined_from_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert hard_negatives.mined(empty, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0], 1), (11, [], 1), (20, [], 2)], "vec_id long, embedding array<double>, label int")
    assert hard_negatives.mined(alone, F.col("vec_id") % 100 == 0).count() == 0


def test_hilbert_visits_neighbours():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(2**bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        place = vector_codes.hilbert(points, bits)
        assert sorted(place.tolist()) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_every_nearest():
    rng = np.random.default_rng(8)
    entries = rng.integers(-20, 20, (12, 3))
    pieces = rng.integers(-20, 20, (300, 3))
    pieces = pieces[vector_codes.curve_order(pieces)]
    first, low, high, sums, size = vector_codes.boxed(pieces, 8)
    lists = vector_codes.shortlists(low, high, entries)
    far = ((pieces[:, None] - entries[None]) ** 2).sum(axis=2)
    assert all(lists[i // 8, far[i] == far[i].min()].all() for i in range(300))
    assert lists.mean() < 0.9 and sums.sum() == pieces.sum() and size.sum() == 300
    seen = {}
    for rows, entry, distance in vector_codes.assigned(pieces, first, size, lists, entries, np.arange(len(first))):
        seen |= {r: (e, f) for r, e, f in zip(rows.tolist(), entry.tolist(), distance.tolist())}
    assert seen == {i: (int(far[i].argmin()), int(far[i].min())) for i in range(300)}


def brute_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    fine = [(i, [int(np.floor(scale * x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in fine) // parts)) * parts
    data = np.array([v + [0] * (width - len(v)) for _, v, _ in fine]).reshape(len(fine), parts, -1)
    seeds = sorted((i, v, n) for n, (i, v, _) in enumerate(fine) if i is not None)[:entries]
    books = np.stack([data[n] for _, _, n in seeds], axis=1)
    near = lambda: [((data[:, p, None] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
    for _ in range(rounds):
        for p, far in enumerate(near()):
            own = far.argmin(axis=1)
            for e in set(own.tolist()):
                books[p, e] = data[own == e, p].sum(axis=0) // (own == e).sum()
    far = near()
    codes = np.stack([f.argmin(axis=1) for f in far], axis=1)
    error = np.stack([f.min(axis=1) for f in far], axis=1).sum(axis=1)
    return sorted(repr((i, lab, c, e)) for (i, _, lab), c, e in zip(fine, codes.tolist(), error.tolist())), books


@pytest.mark.parametrize(("chunk", "block", "entries"), [(1 << 22, 64, 64), (320, 3, 5)])
def test_codes(spark, rows, chunk, block, entries):
    rng = random.Random(4)
    more = rows + [(i, [rng.uniform(-1, 1) for _ in range(rng.choice([16, 20, 32]))], rng.choice([1, None, 7])) for i in range(400, 600)]
    frame = spark.createDataFrame([(*r, "x", b"", 1) for r in more], 'vec_id long, embedding array<double>, label int, codes string, pieces binary, error int').repartition(3)
    found, books = vector_codes.compressed(frame, entries=entries, chunk=chunk, block=block)
    wanted, wanted_books = brute_codes(more, entries=entries)
    assert (books == wanted_books).all()
    assert sorted(repr((r["vec_id"], r["label"], r["codes"], r["error"])) for r in found.collect()) == wanted


def test_codes_of_little(spark):
    schema = "vec_id long, embedding array<double>, label int"
    found, _ = vector_codes.compressed(spark.createDataFrame([], schema))
    assert found.count() == 0
    found, books = vector_codes.compressed(spark.createDataFrame([(None, [0.5], 1), (None, [], None)], schema))
    assert sorted(r["error"] for r in found.collect()) == [0, 128**2] and books.shape == (16, 1, 1)
    long = spark.createDataFrame([(1, [0.25] * 100_000, 1), (2, [0.25] * 99_999 + [0.5], 1), (3, [0.25] * 99_999 + [0.5], 2)], schema)
    assert [r["error"] for r in vector_codes.compressed(long)[0].collect()] == [0, 0, 0]
