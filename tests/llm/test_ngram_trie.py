"""The n-gram trie against plain dictionaries, and texts scored by it."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import base, ngram_trie

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("n", "most"), [(0, 5), (1, 1), (50, 60), (300, 10**6), (300, 2**40)])
def test_elias_fano(n, most):
    rng = random.Random(n)
    values = np.array(sorted(rng.sample(range(most), n)), dtype=np.int64)
    packed = ngram_trie.elias_fano(values)
    own = ngram_trie.Sequence(packed["n"], packed["l"], packed["upper"], packed["lower"])
    assert own.at(np.arange(n)).tolist() == values.tolist()
    wanted = np.array([*values.tolist(), 0, most, most + 9, *[rng.randrange(most) for _ in range(50)]])
    whole = np.zeros(len(wanted), dtype=np.int64)
    place = {v: i for i, v in enumerate(values.tolist())}
    assert own.find(wanted, whole, whole + n).tolist() == [place.get(x, -1) for x in wanted.tolist()]
    assert own.find(wanted, whole + n // 3, whole + n // 2).tolist() == [i if n // 3 <= i < n // 2 else -1 for i in (place.get(x, -1) for x in wanted.tolist())]
    assert 8 * (len(packed["upper"]) + len(packed["lower"])) <= n * (3 + math.log2(max(2, most / max(n, 1)))) + 100


def plain_weights(counts, discount=0.75):
    """A and B of (v, u, w) from counts of (v, u, w)."""
    two, three, pair = defaultdict(Counter), defaultdict(Counter), Counter()
    for (v, u, w), c in counts.items():
        two[v][w] += c
        three[v, u][w] += c

    def level(of, w):
        total = sum(of.values())
        return (max(of[w] - discount, 0) / total if w in of else 0.0, discount * len(of) / total) if total else (0.0, 1.0)

    def weights(v, u, w):
        a2, b2 = level(two.get(v, pair), w)
        a3, b3 = level(three.get((v, u), pair), w)
        return a3 + b3 * a2, b3 * b2

    return weights


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_trie_equals_dictionaries(n):
    rng = random.Random(n)
    names = [rng.getrandbits(64) for _ in range(12)] + [5, 6]
    counts = Counter((rng.choice(names[:5]), rng.choice(names), rng.choice(names)) for _ in range(n))
    rows = np.array([(*k, c) for k, c in counts.items()], dtype=np.uint64).reshape(-1, 4)
    trie = ngram_trie.Trie(ngram_trie.built(rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]))
    asked = np.array([(v, u, w) for v in [*names[:6], 99] for u in [*names, 98] for w in [*names, 97]], dtype=np.uint64)
    a, b = trie.weights(*asked.T)
    weights = plain_weights(counts)
    wanted = np.array([weights(*map(int, x)) for x in asked])
    assert np.allclose(a, wanted[:, 0], rtol=1e-3, atol=1e-12) and np.allclose(b, wanted[:, 1], rtol=1e-3)
    # of a context all words together take what the discounts leave
    for v, u in {(k[0], k[1]) for k in list(counts)[:20]}:
        known = np.array(names, dtype=np.uint64)
        a, b = trie.weights(np.full(len(known), v, dtype=np.uint64), np.full(len(known), u, dtype=np.uint64), known)
        assert abs(a.sum() + b[0] - 1) < 1e-3 and np.ptp(b) == 0


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]


def key_of(plan, word):
    if word is None:
        return ngram_trie.START
    own = ngram_trie.END if word == "" else np.uint64(base.words_of(pa.array([word]), base.NONSPACE, base.LOWER).hashes[0])
    return int(ngram_trie._places(plan.hashes, np.array([own]), ngram_trie.OTHER)[0]), int(own)


def brute_scores(rows, learn, plan=None):
    """n_tokens, n_known, train_tokens, base_score, score; with a plan, contexts back off within its shards."""
    keys = {}

    def place(u, v):
        if plan is None:
            return 0
        pair = []
        for x in (v, u):
            if x is None:
                pair.append((ngram_trie.START, ngram_trie.START))
            else:
                keys.setdefault(x, key_of(plan, x))
                code, own = keys[x]
                pair.append((code, own if code == ngram_trie.OTHER else code))
        (vc, vk), (uc, uk) = pair
        shard, _, _ = plan.shard_of(np.array([vc]), np.array([uc]), np.array([vk], dtype=np.uint64), np.array([uk], dtype=np.uint64))
        return int(shard[0])

    def grams(text):
        own = [None, None, *tokens(text), ""]
        return [((place(own[i - 2], own[i - 1]), own[i - 1]), own[i - 2], own[i]) for i in range(2, len(own))]

    taught = [grams(t) for i, t in rows if learn(i)]
    counts, one = Counter(g for own in taught for g in own), Counter(g[2] for own in taught for g in own)
    total, distinct = sum(one.values()), len(one)
    weights = plain_weights(counts)
    out = []
    for i, t in rows:
        own = grams(t)
        alone = [max(one[g[2]] - 0.75, 0) / total + 0.75 * distinct / total / (distinct + 1) if total else 1 / (distinct + 1) for g in own]
        score = sum(math.log10(a + b * p) for (a, b), p in zip((weights(*g) for g in own), alone))
        out.append((i, len(own), sum(g[2] in one for g in own), total, sum(math.log10((one[g[2]] + 1) / (total + distinct + 1)) for g in own), score))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    names = ["the", "of", "Sea", "ñandú", "x1", "rain,", "stone", "a"]
    out = [(i, " ".join(rng.choice(names) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    out += [(100 + i, "of the same line once more") for i in range(40)] + [(200, None), (201, ""), (202, "\n\t"), (None, "a stone"), (None, None), (5, "used id"), (300, "never seen words here " * 400)]
    return out


def close(found, wanted):
    found, wanted = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[1:4], round(r[5], 3))) for x in (found, wanted))
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for f, w in zip(found, wanted):
        assert f[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and f[5] == pytest.approx(w[5], rel=1e-3, abs=1e-6)


@pytest.mark.parametrize(("shard_tokens", "codes"), [(1_000_000, 65_534), (60, 65_534), (60, 4), (1_000_000, 1)])
def test_scores(spark, rows, shard_tokens, codes, monkeypatch):
    monkeypatch.setattr(ngram_trie, "CODES", codes)
    monkeypatch.setattr(ngram_trie, "HOT_SHARE", 16)
    # extra columns with the names that the operator uses inside
    frame = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in rows], "doc_id long, text string, _row int, word string, score double").repartition(3).cache()
    texts = frame.select("text", (~ngram_trie.held_out("doc_id")).alias("_learn"), F.col("text").alias("_text"))
    plan = ngram_trie.planned(ngram_trie.counted(texts.select("_text", "_learn")), shard_tokens)
    if shard_tokens == 60 and codes > 4:
        assert (plan.parts > 1).any() and len(plan.hot) and plan.salts.max() > 1
    found = ngram_trie.scored(frame, ~ngram_trie.held_out("doc_id"), shard_tokens=shard_tokens)
    got = [tuple(r) for r in found.select("doc.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    close(got, brute_scores(rows, lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2, plan if shard_tokens == 60 else None))


@pytest.mark.parametrize("shard_tokens", [25, 60, 90])
def test_scores_do_not_depend_on_the_size_of_shards(spark, rows, shard_tokens):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    texts = frame.select("text", (~ngram_trie.held_out("doc_id")).alias("_learn"), F.col("text").alias("_text"))
    plan = ngram_trie.planned(ngram_trie.counted(texts.select("_text", "_learn")), shard_tokens)
    assert (plan.parts > 1).sum() > 1 and len(plan.hot)
    found = ngram_trie.scored(frame, ~ngram_trie.held_out("doc_id"), shard_tokens=shard_tokens)
    got = [tuple(r) for r in found.select("doc.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    close(got, brute_scores(rows, lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2))


def test_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_trie.scored(empty, F.lit(True)).count() == 0
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = ngram_trie.scored(frame, F.lit(False)).orderBy("doc.doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


def test_model_as_a_table(spark, rows):
    frame = spark.createDataFrame([(i, t, True) for i, (_, t) in enumerate(rows)], "_row long, _text string, _learn boolean").coalesce(1)
    plan = ngram_trie.planned(ngram_trie.counted(frame), 60)
    shards = ngram_trie.tries(ngram_trie.packed_places(frame, plan)).collect()
    assert len({r["shard"] for r in shards}) == len(shards) > 3
    assert sum(ngram_trie.Trie(bytes(r["trie"])).sequence["roots"].n for r in shards) >= len({w for _, t in rows for w in tokens(t)})


def test_quantised_values():
    values = np.random.default_rng(1).uniform(1e-6, 1, 20_000)
    table, codes = ngram_trie._coded(values)
    assert len(table) <= ngram_trie.VALUES and np.abs(np.log(table[codes] / values)).mean() < 1e-3


def test_op13(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = ngram_trie.op13_elias_fano_scores(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found)
    close([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found], brute_scores(docs, lambda i: zlib.crc32(str(i).encode()) % 7 != 2))
    # held-out texts are scored far better than by words alone
    mean = {h: sum(r["score"] - r["base_score"] for r in found if r["held_out"] == h) for h in (True, False)}
    assert mean[True] > 0 and mean[False] > 0


def test_a_shard_takes_little_memory():
    """What building and answering a shard takes for each place, beside the places themselves."""
    rng, n = np.random.default_rng(1), 200_000
    keys = [rng.integers(0, 3_000, n).astype(np.uint64) for _ in range(3)]
    pieces = [(0, [k[a : a + 8192].copy() for k in keys], (np.arange(len(keys[0][a : a + 8192])) << 1 | 1).astype("<u2")) for a in range(0, n, 8192)]
    plan = ngram_trie.Plan(n, 3_000, np.arange(3_000, dtype=np.uint64), np.full(3_000, 67), 1, np.ones(ngram_trie.START + 1, dtype=np.int32), np.zeros(1, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    del keys
    tracemalloc.start()
    try:
        list(ngram_trie.answer(plan, pieces, ngram_trie.Sums(), 0.75))
        assert tracemalloc.get_traced_memory()[1] / n < 300
    finally:
        tracemalloc.stop()
