"""SimHash, winnowing, fixed blocks and sharding against brute force on small rows with every odd case."""

import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import base, decontamination, sharding, simhash, substrings

WORDS = ["the", "of", "sea", "Ünder", "x1", "rain", "stone", "a", "light", "MARK", "ñandú", "river"]
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared = [prose(rng, 30) for _ in range(3)]
    out = [(i, prose(rng, rng.randint(0, 60)) + " " + rng.choice(shared + ["", ""]) + " " + prose(rng, rng.randint(0, 20))) for i in range(60)]
    out += [(100, None), (101, ""), (102, " \n\t "), (103, out[3][1]), (104, out[3][1]), (5, out[5][1]), (None, out[7][1]), (None, None), (106, "one two"), (107, prose(rng, 8000) + shared[0])]
    out += [(3, shared[1] + " other text under a used id")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # extra columns with the names that the operators use inside
    return spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in rows], "doc_id long, text string, tag int, places string, score double").repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def counted(values):
    return sorted(values, key=repr)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs, rows):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    wanted = counted((doc, prints[i], ids.get(find(i))) for i, (doc, _) in enumerate(rows))
    found = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert counted((r[0], r[1] % (1 << 64), r[2]) for r in found) == wanted


def test_bit_sliced_groups_match_pairs():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(6)]]))
    far = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for radius in (0, 1, 2, 3, 7, 12, 24, 40):
        i, j = map(np.concatenate, zip(*simhash.close_pairs(prints, radius), strict=True)) if radius else (np.zeros(0, int),) * 2
        wanted = np.argwhere(np.triu(far <= radius, 1))
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, wanted.tolist()))
        root = simhash.merged(np.arange(len(prints)), i, j)
        assert (root[i] == root[j]).all()


def test_blocks_over_the_radius_are_left(monkeypatch):
    import numpy as np

    seen = []
    real = simhash._over
    monkeypatch.setattr(simhash, "_over", lambda counters, over, radius: seen.append(len(over)) or real(counters, over, radius))
    list(simhash.close_pairs(np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64), 2))
    assert seen[0] == 636 and seen[-1] < 64


def test_simhash_tiles_lose_no_link(spark, monkeypatch):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base} | {base ^ (1 << a) for a in range(30)} | {base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(40, 52)}
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    monkeypatch.setattr(simhash, "TILE", 16)
    roots = simhash.components(simhash.links(nodes)).collect()
    assert len(roots) == len(prints) - 1 and len({r["root"] for r in roots}) == 1  # the root itself has no row


def test_one_of_each_keeps_one_row(docs, rows):
    kept = simhash.one_of_each(docs).collect()
    groups = {r["group"] for r in simhash.near_duplicates(docs).collect()}
    assert len(kept) == len(groups)
    assert (3, rows[3][1]) in {(r["doc_id"], r["text"]) for r in kept}
    assert not {103, 104} & {r["doc_id"] for r in kept}


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


def by_brute_force(rows, items):
    windows = {}
    for item, text in items:
        w = re.findall(ALNUM, lower(text))
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w = re.findall(ALNUM, lower(text))
        hit, own = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (names := windows.get(tuple(w[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    own |= names
        out.append((doc, len(w), len(hit), tuple(sorted(own))))
    return counted(out)


@pytest.mark.parametrize("most", [500_000, 0])
def test_decontamination(spark, docs, rows, most):
    rng = random.Random(9)
    parts = re.findall(r"\S+", rows[10][1] + " " + rows[20][1] + " " + rows[69][1])
    items = [(i, " ".join(parts[i * 5 : i * 5 + rng.randint(3, 25)])) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, "one, TWO"), (54, items[2][1]), (55, "stone"), (None, items[3][1]), (2, items[2][1])]
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = decontamination.contaminated(docs.withColumn("items", F.lit(1)), table, broadcast_windows=most).collect()
    assert counted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found) == by_brute_force(rows, items)


def test_decontamination_without_items(spark, docs, rows, nothing):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontamination.contaminated(docs, empty).collect()} == {0}
    assert decontamination.contaminated(nothing, empty).count() == 0


def kept_words(rows):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    order = lambda i: float("inf") if i is None else i
    for i, w in split:
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            first[key] = min(first.get(key, float("inf")), order(i))
    out = []
    for i, w in split:
        lost = set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < order(i):
                lost |= set(range(p, p + 13))
        out.append((i, len(w), len(lost), " ".join(x for p, x in enumerate(w) if p not in lost)))
    return counted(out)


@pytest.mark.parametrize("hot", [1, 2, 4, 10**9])
def test_repeated_passages(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", hot)
    found = substrings.without_repeats(docs).collect()
    assert counted(tuple(r) for r in found) == kept_words(rows)
    assert any(r["n_removed"] for r in found)


def test_too_many_common_windows_travel(docs, rows, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 2)
    monkeypatch.setattr(substrings, "MOST_HOT", 3)
    assert counted(tuple(r) for r in substrings.without_repeats(docs).collect()) == kept_words(rows)


def test_repeated_passages_of_nothing(nothing):
    assert substrings.without_repeats(nothing).count() == 0


def feistel(x, n, seed=0):
    """Place of x under the permutation of [0, n), by the law in words: halves of a * b >= n, four rounds, walk until inside."""
    import math

    import xxhash

    mask = lambda v: v - (1 << 64) if v >> 63 else v
    a = math.isqrt(n - 1) + 1 if n else 0
    b = (n + a - 1) // a
    while True:
        left, right = divmod(x, b)
        for i, key in enumerate((11, 23, 37, 51)):
            half = right if i % 2 == 0 else left
            first = xxhash.xxh64_intdigest(half.to_bytes(8, "little"), 42)
            mixed = mask(xxhash.xxh64_intdigest((seed * 1000 + key).to_bytes(4, "little"), first))
            if i % 2 == 0:
                left = (left + mixed % a) % a
            else:
                right = (right + mixed % b) % b
        x = left * b + right
        if x < n:
            return x


def test_shard_query_by_brute_force(spark, tmp_path):
    import zlib

    rng = random.Random(5)
    texts = [(rng.randrange(60), rng.choice(["", None, "é😀", "x" * 5000, "plain words"])) for _ in range(137)]
    spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, shard string").write.parquet(str(tmp_path / "documents.parquet"))
    found = sharding.op3_feistel_shards(spark, str(tmp_path)).collect()
    facts = lambda i, t: (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert counted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == counted(facts(i, t) for i, t in texts)
    for r in found:
        at = feistel(r["row_number"], len(texts))
        assert (r["shard"], r["slot"], r["law"], r["grown_shard"]) == (at % 40, at // 40, "rows", None)
    assert sorted((r["shard"], r["slot"]) for r in found) == sorted((p % 40, p // 40) for p in range(len(texts)))


@pytest.mark.parametrize("shards", [1, 7, 200])
def test_shards(docs, rows, shards):
    found = sharding.sharded(docs, shards).collect()
    assert sorted(r["row_number"] for r in found) == list(range(len(rows)))
    assert sorted(r["position"] for r in found) == list(range(len(rows)))
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.sharded(docs.repartition(7), shards).collect()
    key = lambda r: (r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"])
    assert counted(map(key, found)) == counted(map(key, again))
    other = sharding.sharded(docs, shards, seed=1).collect()
    assert shards == 1 or counted(map(key, found)) != counted(map(key, other))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 100, 1000])
def test_permutation_is_whole(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "row_number").withColumn("n_rows", F.lit(n).cast("long"))
    assert sorted(r["position"] for r in sharding.permuted(rows).collect()) == list(range(n))


def test_shards_of_nothing(nothing):
    assert sharding.sharded(nothing, 40).count() == 0


def alike(letters):
    """A string of 1,024 letters and its exchange: equal under every polynomial modulo 2 ** 64."""
    a, b = letters
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("letters", ["ab", "xq"])
def test_exchanged_strings_are_no_repeats(spark, letters):
    one, two = (" ".join(f"{word}{i}" for i in range(14)) for word in alike(letters))
    frame = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert [r["n_removed"] for r in substrings.without_repeats(frame).collect()] == [0, 0]
    items = spark.createDataFrame([("i", one)], "item_id string, text string")
    assert {r["doc_id"]: r["n_hit"] for r in decontamination.contaminated(frame, items).collect()} == {1: 14, 2: 0}


def test_exchanged_windows_have_hashes_of_their_own():
    order = "".join(alike("xy")[0])
    words = [order, order.translate(str.maketrans("xy", "yx"))]
    for n in (8, 16, 32):
        own = base.words_of(pa.array([" ".join(w[:n]) for w in words]), base.NONSPACE)
        assert len(set(own.windows(n)[1].tolist())) == 2
