"""The pipeline's near-duplicate stage: planted copies in which some words differ, against brute force over all pairs."""

import random

import corpus_pipeline
import numpy as np
import pytest
from strandline.llm import simhash, simhash_similarity


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"edit{rng.randrange(10**6)}"
    return out


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(x, y):
    return 9 * len(x & y) >= 4 * (len(x) + len(y))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    line = rng.choices(vocabulary, k=14)
    out = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([60, 150, 400, 1500]))
        at = rng.randrange(len(base))
        base = base[:at] + line + base[at:]
        out.append(base)
        out += [edited(rng, base, max(1, int(len(base) * share))) for share in (0.005, 0.01, 0.02, 0.025, 0.03, 0.05)]
    hub = rng.choices(vocabulary, k=300)
    out += [edited(rng, hub, rng.randint(1, 9)) for _ in range(60)]
    texts = [" ".join(w) for w in out] + ["one two", "One  two", "one", "", " \n", None, " ".join(out[0])]
    return [(i if i != 3 else None, t) for i, t in enumerate(texts)]


def wanted(rows):
    own = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(own[i], own[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_stage_keeps_one_of_each_group_of_similar_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    groups = {}
    for (doc, text), root in zip(rows, wanted(rows), strict=True):
        groups.setdefault(root, []).append((doc is None, doc or 0, doc, text))
    assert len(groups) < len(rows) - 60
    assert kept == {min(g, key=lambda r: r[:2])[2:] for g in groups.values()}


def test_small_tiles_change_nothing(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash_similarity, "TILE", 8)
    assert len({r["group"] for r in simhash_similarity.grouped(docs).collect()}) == len(set(wanted(rows)))


def test_every_similar_pair_shares_a_key_and_passes_radius_and_bounds():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 3000))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        other = np.unique(np.concatenate((base[: len(base) - len(base) // 10], rng.integers(0, 2**63, len(base) // 10, dtype=np.uint64))))
        assert similar(set(base.tolist()), set(other.tolist()))
        assert (np.equal(*simhash_similarity.band_keys([base, other]))).any()
        prints = np.array([simhash.majority(s) for s in (base, other)], dtype=np.uint64)
        a, _ = simhash_similarity.group_pairs(np.array([1, 2]), np.array([len(base), len(other)]), prints, [simhash_similarity.bitmap(s) for s in (base, other)], np.array([1, 2]), True)
        assert len(a) == 1


def test_a_forest_connects_what_all_pairs_connect():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 2**63, 200, dtype=np.uint64)
        for _ in range(40):
            own = base.copy()
            own[rng.integers(0, 200, rng.integers(0, 12))] = rng.integers(0, 2**63)
            sets.append(np.unique(own))
    node, n = np.arange(len(sets)), np.array([len(s) for s in sets])
    prints, bits = np.array([simhash.majority(s) for s in sets], dtype=np.uint64), [simhash_similarity.bitmap(s) for s in sets]
    few, many = (simhash_similarity.group_pairs(node, n, prints, bits, node, every) for every in (False, True))
    assert len(few[0]) < len(sets) <= len(many[0])
    assert (simhash.merged(node.copy(), *few) == simhash.merged(node.copy(), *many)).all()


def test_no_rows(spark):
    assert simhash_similarity.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7, "x"), (2, "a b c d e f", 8, "y")], "doc_id long, text string, own long, `_id` string")
    kept = simhash_similarity.one_of_each(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d e f", 7, "x")]
