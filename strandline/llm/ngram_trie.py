"""A trigram language model as Elias-Fano tries, one for each shard of contexts, and texts scored by them.

Model. Absolute discounts, interpolated: p(w | u v) = a3 + b3 * (a2 + b2 * p(w)), where a3 = (c(u v w) - D) / c(u v .) and
b3 is what the discounts free; the same for v alone, and p(w) = (c(w) - D) / N + D * V / N / (V + 1), so that all words
and one unknown word have probabilities that add up to one. A text is its words and one end; two starts come before.

Shards. All that the context u v needs lies under v: its successors, the contexts u before it, and their successors. Words
are dealt to shards of about SHARD_TOKENS places by hash. A word that has more places than that is split: its contexts are
dealt to parts by a hash of u, so that shards grow in number, not in size, with the corpus. What such a word backs off to
is the same as if it were whole: its pairs are added up over all parts in a pass of their own, and each part is handed the
sums of the pairs that it meets (`handed_pairs`). A pair u v that has a thousandth of all places has a shard of its own,
whose places are dealt out once more; that shard is built in each of those tasks from counts that were added up before.

A shard's trie has three levels: words v; their successors and, beside them, contexts u; successors of contexts. A level
is one Elias-Fano sequence, ranges of it bounded by a second one of pointers. Ranges are made monotone by adding what the
one before ended with. Successors of a context are stored as places among the successors of v (context-relative), and
values as codes of a table of VALUES. The trie is one block of bytes, written to an unlinked temporary file and mapped; a
search goes to the bucket of the upper bits and compares lower bits there.

Flow. One pass counts words, and one the pairs of split words. One pass packs all places by shard (codes of the CODES most
frequent words are stored by planes of bytes, others are a hash of eight bytes), one shuffle brings them together, and each task builds a shard from the places of training texts,
maps it and answers all places, so that the model never passes through the driver. Places of words that have no code get
p(w) and their count by a join with the counts. Sums are added up by text.

Defined cases: a null text is an empty one (its end is its only token); very long texts are taken whole, in a block of
their own; equal texts and repeated ids are rows each; a null id is kept, and its row is no held-out one; without training
texts every probability is that of the one unknown word; rows must come in the same
order whenever docs is read, as those of a table do; an empty table gives no rows; other columns stay. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import mmap
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import LOWER, NONSPACE, column, mixed, slices, words_of, written

DISCOUNT = 0.75
#: Most frequent words with codes: what is shared with all tasks has this size.
CODES = 524_286
START, OTHER = 524_286, 524_287
#: Training tokens of one shard.
SHARD_TOKENS = 1_000_000
#: Pairs with this share of all places have a shard of their own.
HOT_SHARE = 1024
#: Texts whose sums a task holds before it hands them on.
MOST_SUMS = 500_000
#: Values that a level's quantised weights can take.
VALUES = 4096
#: Triples that are looked up in a trie at once.
LOOKUPS = 1 << 16
BLOCK_BYTES = 6_000_000
#: Texts of a block, and places of one packed row.
BLOCK_TEXTS, PIECE = 32_767, 8_192
#: What stands for an end, and for a start in pairs.
END, FIRST = np.uint64(0x5851F42D4C957F2D), np.uint64(1)
U64 = np.uint64


# --- Elias-Fano -----------------------------------------------------------------------------------------------------


def elias_fano(values: np.ndarray) -> dict:
    """n, l and the bits of a monotone sequence: upper bits in unary buckets, l lower bits packed."""
    values = values.astype(U64)
    n, universe = len(values), int(values[-1]) + 1 if len(values) else 1
    low = min(56, max(0, (universe // max(n, 1)).bit_length() - 1))
    upper = (values >> U64(low)).astype(np.int64)
    bits = np.zeros(n + (universe >> low) + 1, dtype=np.uint8)
    bits[upper + np.arange(n)] = 1
    lower = np.zeros((n, low), dtype=np.uint8)
    for j in range(low):
        lower[:, j] = (values >> U64(j)) & U64(1)
    packed = np.packbits(lower.reshape(-1), bitorder="little")
    return {"n": n, "l": low, "upper": np.packbits(bits, bitorder="little"), "lower": np.concatenate((packed, np.zeros(8, dtype=np.uint8)))}


class Sequence:
    """A mapped sequence. The borders of its buckets are unpacked when it is opened, its lower bits where they are read."""

    def __init__(self, n: int, low: int, upper: np.ndarray, lower: np.ndarray):
        self.n, self.low = n, low
        # eight bytes from any byte on
        self.lower = np.ndarray(max(len(lower) - 7, 0), dtype="<u8", buffer=np.ascontiguousarray(lower), strides=(1,))
        zeros = np.flatnonzero(np.unpackbits(upper, bitorder="little") == 0)
        self.starts = np.minimum(np.concatenate(([0], zeros - np.arange(len(zeros)))), n)

    def _lower(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.low
        return (self.lower[bit >> 3] >> (bit & 7).astype(U64)) & U64((1 << self.low) - 1)

    def at(self, places: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.searchsorted(self.starts, places, side="right") - 1
        upper = np.searchsorted(self.starts, places, side="right") - 1
        return (upper << self.low) | self._lower(places).astype(np.int64)

    def find(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the wanted values within begin:end, where values rise strictly; -1 where there is none."""
        bucket = np.minimum(wanted >> self.low, len(self.starts) - 2)
        lo, stop = np.maximum(self.starts[bucket], begin), np.minimum(self.starts[bucket + 1], end)
        hi, lower = stop.copy(), (wanted & ((1 << self.low) - 1)).astype(U64)
        active = np.flatnonzero(lo < hi)
        while len(active) and self.low:
            middle = (lo[active] + hi[active]) >> 1
            less = self._lower(middle) < lower[active]
            lo[active] = np.where(less, middle + 1, lo[active])
            hi[active] = np.where(less, hi[active], middle)
            active = active[lo[active] < hi[active]]
        found = np.flatnonzero((wanted >> self.low == bucket) & (lo < stop))
        if self.low:
            found = found[self._lower(lo[found]) == lower[found]]
        out = np.full(len(wanted), -1, dtype=np.int64)
        out[found] = lo[found]
        return out


# --- Tries ----------------------------------------------------------------------------------------------------------


def _order(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Order of triples of numbers under n by (v, u, w)."""
    if n <= 1 << 21:
        return np.argsort((v.astype(np.int64) << 42) | (u.astype(np.int64) << 21) | w.astype(np.int64), kind="stable")
    return np.lexsort((w, u, v))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First rows of runs of equal values of sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))))


def _monotone(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """values of ranges that begin at first, each raised by what the range before ended with."""
    ends = np.concatenate((first[1:], [len(values)]))
    raised = np.cumsum(np.concatenate(([0], values[ends - 1][:-1]))) if len(first) else first
    return values + np.repeat(raised, ends - first)


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """VALUES values at most, and for each value the one nearest to it by ratio."""
    logs = np.log10(values)
    known = np.unique(logs)
    if len(known) > VALUES:
        known = np.unique(np.quantile(known, np.linspace(0, 1, VALUES)))
    middle = (known[1:] + known[:-1]) / 2
    return 10.0**known, np.searchsorted(middle, logs).astype(np.uint16)


def numbered(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys in order, and the number of each key among them. Keys of coded words are small and not sorted."""
    seen = np.zeros(OTHER + 1, dtype=bool)
    small = [k <= OTHER for k in keys]
    for k, own in zip(keys, small, strict=True):
        seen[k[own].astype(np.int64)] = True
    codes = np.flatnonzero(seen)
    rest = [k[~own] for k, own in zip(keys, small, strict=True)]
    large, which = np.unique(np.concatenate(rest), return_inverse=True)
    place, out, at = np.cumsum(seen) - 1, [], 0
    for k, own, r in zip(keys, small, rest, strict=True):
        ids = np.empty(len(k), dtype=np.int32)
        ids[own] = place[k[own].astype(np.int64)]
        ids[~own] = which[at : at + len(r)] + len(codes)
        out.append(ids)
        at += len(r)
    return np.concatenate((codes.astype(U64), large)), out


def counted_runs(v: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Order of triples of numbers under n, first places of equal ones in it, and the distinct ones with their summed c."""
    order = _order(v, u, w, n)
    v, u, w = v[order], u[order], w[order]
    first = _runs(v, u, w)
    total = np.add.reduceat(c[order].astype(np.int64), first) if len(first) else np.zeros(0, dtype=np.int64)
    return order, first, (v[first], u[first], w[first], total)


@dataclass
class Handed:
    """What a part is handed of its word: the word's key, its places and successors in all parts, and counts of its pairs
    with words, where they are more than the part's own."""

    v: int
    total: int
    kinds: int
    words: np.ndarray
    counts: np.ndarray


def built(v: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, discount: float = DISCOUNT, handed: Handed | None = None) -> bytes:
    """The trie of counted trigrams of word keys; equal ones are added up."""
    if handed is None:
        keys, (v, u, w) = numbered([v, u, w])
        return packed_trie(keys, *counted_runs(v, u, w, c, len(keys))[2], discount)
    keys, (v, u, w, root, words) = numbered([v, u, w, np.array([handed.v], dtype=U64), handed.words])
    own = replace(handed, v=int(root[0]), words=words)
    return packed_trie(keys, *counted_runs(v, u, w, c, len(keys))[2], discount, own)


def packed_trie(keys: np.ndarray, v: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray, discount: float, handed: Handed | None = None) -> bytes:
    """The trie of distinct trigrams of numbers of keys, in order, and their counts. With handed, whose words are numbers
    too, all trigrams are of its word."""
    roots = v[_runs(v)]
    # successors of v
    by_word = np.argsort((v.astype(np.int64) << 32) | w, kind="stable")
    bv, bw = v[by_word], w[by_word]
    pair = _runs(bv, bw)
    count2 = np.add.reduceat(c[by_word], pair) if len(pair) else c
    bv, bw = bv[pair], bw[pair]
    if handed is not None and handed.kinds:
        roots = np.array([handed.v])
        bw, first = np.unique(np.concatenate((handed.words, bw)), return_index=True)
        bv, count2 = np.full(len(bw), handed.v), np.concatenate((handed.counts, count2))[first]
        first2, total2, kinds2 = np.zeros(1, dtype=np.int64), np.array([handed.total]), np.array([handed.kinds])
        held2 = np.array([len(bw)])
    else:
        first2 = _runs(bv)
        total2 = np.add.reduceat(count2, first2) if len(first2) else count2
        held2 = kinds2 = np.diff([*first2, len(bv)])
    # contexts of v and their successors
    first3 = _runs(v, u)
    cv, cu = v[first3], u[first3]
    total3 = np.add.reduceat(c, first3) if len(first3) else c
    kinds3 = np.diff([*first3, len(v)])
    pairs, mine = (bv.astype(np.int64) << 32) | bw, (v.astype(np.int64) << 32) | w
    del by_word, bv, w
    place = np.searchsorted(pairs, mine) if len(v) else v
    del pairs, mine
    if len(v):
        place = place - first2[np.searchsorted(roots, v)]
    first_context, context_pointers = _runs(cv), np.append(np.searchsorted(cv, roots), len(cv))
    successor_pointers = np.append(first2, len(bw))
    if not len(bw):
        first2 = first2[:0]
    # made one after another, so that a task holds one of them beside what is packed
    sequences = {
        "roots": lambda: roots,
        "successors": lambda: _monotone(bw, first2),
        "successor_pointers": lambda: successor_pointers,
        "contexts": lambda: _monotone(cu, first_context),
        "context_pointers": lambda: context_pointers,
        "places": lambda: _monotone(place, first3),
        "place_pointers": lambda: np.append(first3, len(v)),
    }
    values = {
        "a2": lambda: (count2 - discount) / np.repeat(total2, held2),
        "b2": lambda: discount * kinds2 / total2,
        "a3": lambda: (c - discount) / np.repeat(total3, kinds3),
        "b3": lambda: discount * kinds3 / total3,
    }
    arrays, facts = {"keys": keys.astype("<u8")}, {}
    for name, sequence in sequences.items():
        packed = elias_fano(sequence())
        facts[name] = [packed["n"], packed["l"]]
        arrays |= {f"{name}.upper": packed["upper"], f"{name}.lower": packed["lower"]}
    for name, own in values.items():
        arrays[f"{name}.table"], arrays[f"{name}.codes"] = _coded(own())
    where, at = {}, 0
    for name, array in arrays.items():
        where[name] = [array.dtype.str, at, len(array)]
        at += -(-array.nbytes // 8) * 8
    head = json.dumps({"sequences": facts, "arrays": where}).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([np.int64(len(head)).tobytes(), head, *[a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values()]])


class Trie:
    """A built trie, mapped from an unlinked file."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int(np.frombuffer(self.map, dtype="<i8", count=1)[0])
        head = json.loads(bytes(self.map[8 : 8 + size]))
        base = 8 + size
        self.array = {name: np.frombuffer(self.map, dtype=kind, count=n, offset=base + at) for name, (kind, at, n) in head["arrays"].items()}
        self.sequence = {name: Sequence(n, low, self.array[f"{name}.upper"], self.array[f"{name}.lower"]) for name, (n, low) in head["sequences"].items()}

    def _ids(self, keys: np.ndarray) -> np.ndarray:
        known = self.array["keys"]
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        return np.where(known[at] == keys, at, -1) if len(known) else np.full(len(keys), -1)

    def _value(self, name: str, at: np.ndarray, missing: float) -> np.ndarray:
        out = np.full(len(at), missing)
        out[at >= 0] = self.array[f"{name}.table"][self.array[f"{name}.codes"][at[at >= 0]]]
        return out

    def _search(self, name: str, pointers: str, parent: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the wanted values among the children of each parent (-1: none), and where those children begin."""
        out, start = np.full(len(wanted), -1), np.zeros(len(wanted), dtype=np.int64)
        real = np.flatnonzero((parent >= 0) & (wanted >= 0))
        first = _runs(parent[real])
        parents, length = parent[real][first], np.diff([*first, len(real)])
        bounds, values = self.sequence[pointers], self.sequence[name]
        begin, end = bounds.at(parents), bounds.at(parents + 1)
        raised = np.where(begin > 0, values.at(np.maximum(begin - 1, 0)), 0)
        out[real] = values.find(wanted[real] + np.repeat(raised, length), np.repeat(begin, length), np.repeat(end, length))
        start[real] = np.repeat(begin, length)
        return out, start

    def weights(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For triples of word keys A and B, so that p(w | u v) = A + B * p(w)."""
        return self.weights_of(*map(self._ids, (v, u, w)))

    def weights_of(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for numbers of keys, -1 for a word that the trie does not have. A look-up takes many times the memory of
        what is asked, so it is made for LOOKUPS triples at once."""
        a, b = np.empty(len(v)), np.empty(len(v))
        for at in range(0, len(v), LOOKUPS):
            own = slice(at, at + LOOKUPS)
            a[own], b[own] = self._looked_up(v[own], u[own], w[own])
        return a, b

    def _looked_up(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours that are equal in v, or in v and u, are looked up once."""
        roots, first, context_first = self.sequence["roots"], _runs(v), _runs(v, u)
        own = v[first]
        root = np.where(own >= 0, roots.find(np.maximum(own, 0), np.zeros(len(own), dtype=np.int64), np.full(len(own), roots.n)), -1)
        root = np.repeat(root, np.diff([*first, len(v)]))
        successor, start = self._search("successors", "successor_pointers", root, w)
        context, _ = self._search("contexts", "context_pointers", root[context_first], u[context_first])
        length = np.diff([*context_first, len(v)])
        third, _ = self._search("places", "place_pointers", np.repeat(context, length), np.where(successor >= 0, successor - start, -1))
        a2, b2 = self._value("a2", successor, 0.0), self._value("b2", root, 1.0)
        a3, b3 = self._value("a3", third, 0.0), np.repeat(self._value("b3", context, 1.0), length)
        return a3 + b3 * a2, b3 * b2


# --- Texts ----------------------------------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Tokens of some texts: distinct hashes, for each token its number among them, first token of each text."""

    known: np.ndarray
    which: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def before(self, n: int) -> np.ndarray:
        """The number of the token n places before each, len(known) for a start."""
        out = np.full(len(self.which), len(self.known), dtype=np.int64)
        out[n:] = self.which[:-n]
        place = np.arange(len(self.which)) - np.repeat(self.first[:-1], np.diff(self.first))
        return np.where(place >= n, out, len(self.known))


def tokens_of(texts: pa.Array) -> Tokens:
    # a few texts at once: what hashing takes is many times their bytes
    batch = pa.RecordBatch.from_arrays([texts], names=["_text"])
    parts = [words_of(column(part, "_text"), NONSPACE, LOWER) for part in slices(batch, "_text")]
    hashes = np.concatenate([np.zeros(0, dtype=U64), *[p.hashes for p in parts]])
    counts = np.concatenate([np.zeros(0, dtype=np.int64), *[p.counts() for p in parts]])
    del parts
    hashes = np.where(hashes <= OTHER, hashes + U64(OTHER + 1), hashes)
    first = np.concatenate(([0], np.cumsum(counts + 1)))
    every = np.full(int(first[-1]), END, dtype=U64)
    every[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
    known, which = np.unique(every, return_inverse=True)
    return Tokens(known, which.astype(np.int64), first)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about BLOCK_BYTES of text, over the borders of batches."""
    held, size, n = [], 0, 0
    for batch in batches:
        for part in slices(batch, "_text", BLOCK_BYTES // 4):
            for at in range(0, len(part), BLOCK_TEXTS):
                own = part.slice(at, BLOCK_TEXTS)
                if held and (size + own.nbytes > BLOCK_BYTES or n + len(own) > BLOCK_TEXTS):
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size, n = [], 0, 0
                held, size, n = [*held, own], size + own.nbytes, n + len(own)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def counted(texts: DataFrame) -> DataFrame:
    """word, other, n over training texts (_row, _text, _learn): words with other null, and pairs (v, u) that a block has
    often: of a pair with a share of 1 / HOT_SHARE at least half of all places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            block = block.filter(column(block, "_learn"))
            if not len(block):
                continue
            tokens = tokens_of(column(block, "_text"))
            n = np.bincount(tokens.which, minlength=len(tokens.known))
            least = len(tokens.which) / (2 * HOT_SHARE)
            frequent, v, u = np.append(n >= least, len(tokens.first) > least), tokens.before(1), tokens.before(2)
            both = frequent[v] & frequent[u] & (v < len(n))
            pairs, often = np.unique((v[both] << 32) | u[both], return_counts=True)
            known, pairs, often = np.append(tokens.known, FIRST).view(np.int64), pairs[often >= least], often[often >= least]
            word = pa.array(np.concatenate((known[:-1], known[pairs >> 32])))
            other = pa.concat_arrays([pa.nulls(len(known) - 1, pa.int64()), pa.array(known[pairs & 0xFFFFFFFF])])
            yield pa.RecordBatch.from_arrays([word, other, pa.array(np.concatenate((n, often)))], names=["word", "other", "n"])

    return texts.mapInArrow(run, "word long, other long, n long").groupBy("word", "other").agg(F.sum("n").alias("n"))


def _places(hashes: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(hashes, wanted), max(len(hashes) - 1, 0))
    return np.where(hashes[at] == wanted, at, missing) if len(hashes) else np.full(wanted.shape, missing)


@dataclass
class Plan:
    """What all tasks share: words with codes and their counts, in order of hash; how words and pairs are dealt."""

    total: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray
    shards: int
    parts: np.ndarray
    offset: np.ndarray
    hot: np.ndarray
    salts: np.ndarray

    def codes(self, tokens: Tokens) -> np.ndarray:
        """Codes of the distinct words of tokens, and of a start."""
        return np.append(_places(self.hashes, tokens.known, OTHER), START)

    def alone(self, counts: np.ndarray, discount: float) -> np.ndarray:
        """p(w) of words with these counts."""
        if not self.total:
            return np.full(len(counts), 1.0 / (self.distinct + 1))
        return np.maximum(counts - discount, 0) / self.total + discount * self.distinct / self.total / (self.distinct + 1)

    def places(self, v: int) -> int:
        """Training places whose last word before is v: a start has as many as there are ends."""
        return int(self.counts[v] if v != START else self.counts[self.hashes == END].sum())

    def salts_of(self, shard: np.ndarray) -> np.ndarray:
        at = shard - self.shards - int(self.parts[self.parts > 1].sum())
        salts = np.ones(len(shard), dtype=np.int64)
        salts[at >= 0] = self.salts[at[at >= 0]]
        return salts

    def splits(self) -> Iterator[tuple[int, int]]:
        """Shards that are split off, and the word of each. No word comes after an end."""
        for v in np.flatnonzero(self.parts > 1).tolist():
            for i in range(int(self.parts[v])):
                if not (self.hashes[v : v + 1] == END).any():
                    yield self.shards + int(self.offset[v]) + i, v
        for i, pair in enumerate(self.hot.tolist()):
            yield self.shards + int(self.parts[self.parts > 1].sum()) + i, pair >> 32

    def shard_of(self, v: np.ndarray, u: np.ndarray, v_key: np.ndarray, u_key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard of words that contexts back off to, the shard where they are dealt (another one if split off), and its
        number of salts."""
        home = (mixed(v_key) % U64(self.shards)).astype(np.int64)
        shard = home.copy()
        coded = np.flatnonzero(v <= START)
        split = np.zeros(len(v), dtype=bool)
        split[coded] = self.parts[v[coded]] > 1
        own = np.flatnonzero(split)
        shard[own] = self.shards + self.offset[v[own]] + (mixed(u_key[own]) % self.parts[v[own]].astype(U64)).astype(np.int64)
        salts = np.ones(len(v), dtype=np.int64)
        if len(self.hot):
            pair = (v.astype(np.int64) << 32) | u
            at = np.minimum(np.searchsorted(self.hot, pair), len(self.hot) - 1)
            is_hot = self.hot[at] == pair
            shard[is_hot] = self.shards + int(self.parts[self.parts > 1].sum()) + at[is_hot]
            salts[is_hot] = self.salts[at[is_hot]]
        return home, shard, salts


def planned(counts: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Plan:
    """The plan from written counts. CODES words, 2 * HOT_SHARE pairs and one row for each number of places that words have
    reach the driver at most."""
    words = counts.filter("other IS NULL")
    sizes = words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toPandas().astype(np.int64).sort_values("n", ascending=False)
    total, distinct = int((sizes["n"] * sizes["words"]).sum()), int(sizes["words"].sum())
    # words with as many places are coded together or not at all
    coded = sizes["words"].cumsum() <= CODES
    least_coded, most_other = int(sizes["n"][coded].min()) if coded.any() else total + 1, int(sizes["n"][~coded].max()) if (~coded).any() else 0
    top = words.filter(F.col("n") >= least_coded).select("word", "n").toPandas()
    hashes, n = top["word"].to_numpy(dtype=np.int64).view(U64), top["n"].to_numpy(dtype=np.int64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    # a word that is dealt whole has no more places than a shard; where words without codes have more, shards grow
    size = max(shard_tokens, most_other)
    places = np.zeros(START + 1, dtype=np.int64)
    places[: len(n)] = n
    places[START] = n[hashes == END].sum()
    parts = np.where(places > size, -(-places // size), 1)
    several = np.where(parts > 1, parts, 0)
    least = max(size, total // HOT_SHARE)
    pairs = counts.filter(F.col("other").isNotNull() & (F.col("n") >= least / 2)).toPandas()
    v, u = (pairs[c].to_numpy(dtype=np.int64).view(U64) for c in ("word", "other"))
    v, u, often = _places(hashes, v, OTHER), np.where(u == FIRST, START, _places(hashes, u, OTHER)), pairs["n"].to_numpy(dtype=np.int64)
    # every text has one place after two starts
    v, u, often = np.append(v, START), np.append(u, START), np.append(often, places[START])
    own = (v != OTHER) & (u != OTHER)
    v, u, often = v[own], u[own], often[own]
    own = (parts[v] > 1) & (often >= least / 2)
    hot, salts = ((v << 32) | u)[own], -(-often[own] // least)
    order = np.argsort(hot)
    return Plan(total, distinct, hashes, n, max(1, -(-total // size)), parts.astype(np.int32), (np.cumsum(several) - several).astype(np.int32), hot[order], salts[order])


def _piece(codes: list[np.ndarray], keys: list[np.ndarray], last: np.ndarray) -> bytes:
    """Codes of words by planes of their bytes, then counts or texts, then keys of words without a code; compressed, its
    size before it."""
    planes = np.concatenate(codes).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T
    raw = b"".join([planes.tobytes(), last.tobytes()] + [k[c == OTHER].astype("<u8").tobytes() for c, k in zip(codes, keys, strict=True)])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(data: bytes, n: int, kind: str, words: int = 3) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of so many words (v, u, w), and counts or texts."""
    raw = pa.decompress(memoryview(data)[8:], int(np.frombuffer(data, dtype="<i8", count=1)[0]), codec="zstd")
    planes = np.zeros((words * n, 4), dtype=np.uint8)
    planes[:, :3] = np.frombuffer(raw, dtype=np.uint8, count=3 * words * n).reshape(3, -1).T
    codes = planes.view("<u4").reshape(words, n)
    last = np.frombuffer(raw, dtype=kind, count=n, offset=3 * words * n)
    rest = np.frombuffer(raw, dtype="<u8", offset=3 * words * n + last.nbytes)
    keys, at = [], 0
    for own in codes:
        key, other = own.astype(U64), np.flatnonzero(own == OTHER)
        key[other] = rest[at : at + len(other)]
        keys.append(key)
        at += len(other)
    return keys, last


#: How texts of a block (a bit tells whether they are learned from) and counts are stored.
TEXT_KIND, COUNT_KIND = "<u2", "<u4"
#: How counts of pairs are stored: with the shard that asks above COUNT_BITS, or as sums.
PAIR_KIND, SUM_KIND, COUNT_BITS = "<u8", "<i8", 32
#: Kinds of packed rows: a split word as a whole, sums of its pairs, counts of a shard that is split off, places.
WHOLE, PAIRS, COUNTS, PLACES = -2, -1, 0, 1
PACKED = pa.schema([("shard", pa.int64()), ("salt", pa.int64()), ("kind", pa.int64()), ("base", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
PACKED_DDL = "shard long, salt long, kind long, base long, n long, data binary"
#: Pairs that a task holds before it adds them up, and before it hands them on.
HELD_PAIRS = 2_000_000


def _packed_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[5]) + 64
        if size > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), PACKED, strict=True)], schema=PACKED)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), PACKED, strict=True)], schema=PACKED)


def _code_of(keys: np.ndarray) -> np.ndarray:
    return np.where(keys < OTHER, keys, U64(OTHER)).astype(np.int64)


def _summed_pairs(pieces: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """v, w, shard, n of pieces, in order, equal ones added up."""
    v, w, shard, n = (np.concatenate([p[i] for p in pieces]) for i in range(4))
    order = np.lexsort((shard, w, v))
    v, w, shard, n = v[order], w[order], shard[order], n[order]
    first = _runs(v, w, shard)
    return v[first], w[first], shard[first], np.add.reduceat(n, first)


def handed_pairs(texts: DataFrame, plan: Plan) -> DataFrame:
    """Packed rows for the shards of split words. A block hands on which pairs of a split word and its successor each of the
    word's shards meets, and how often in training texts. They are added up by pair, and each shard gets the sums that are
    more than its own counts; how many successors a word has comes beside them (shard -1, base: the word)."""
    shared = texts.sparkSession.sparkContext.broadcast(plan)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        splits = np.flatnonzero(plan.parts > 1)
        is_split = np.zeros(OTHER + 1, dtype=bool)
        is_split[splits] = True
        for block in blocks(batches):
            tokens = tokens_of(column(block, "_text"))
            codes = plan.codes(tokens)
            keys = np.where(codes == OTHER, np.append(tokens.known, U64(0)), codes.astype(U64))
            before = tokens.before(1)
            at = np.flatnonzero(is_split[codes[before]])
            if not len(at):
                continue
            learn = column(block, "_learn").to_numpy(zero_copy_only=False).astype(np.int64)[tokens.text_of()[at]]
            u, v, w = tokens.before(2)[at], before[at], tokens.which[at]
            _, shard, _ = plan.shard_of(codes[v], codes[u], keys[v], keys[u])
            v, w, shard, n = _summed_pairs([(codes[v], w, shard, learn)])
            key = keys[w]
            bucket = (mixed(key ^ mixed(v.astype(U64))) % U64(plan.shards)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = _runs(bucket[order])

            def rows() -> Iterator[tuple]:
                for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):  # noqa: B023
                    for at in range(a, b, PIECE):
                        own = order[at : min(b, at + PIECE)]  # noqa: B023
                        last = ((shard[own] << COUNT_BITS) | n[own]).astype(PAIR_KIND)  # noqa: B023
                        yield int(bucket[own[0]]), 0, PAIRS, 0, len(own), _piece([v[own], codes[w[own]]], [v[own], key[own]], last)  # noqa: B023

            yield from _packed_batches(rows())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, kinds = shared.value, {}

        def added(pieces: list[tuple]) -> tuple[np.ndarray, ...]:
            v, w, shard, n = _summed_pairs(pieces)
            first = _runs(v, w)
            length, total = np.diff([*first, len(v)]), np.add.reduceat(n, first)
            known, often = np.unique(v[first][total > 0], return_counts=True)
            for word, more in zip(known.tolist(), often.tolist(), strict=True):
                kinds[word] = kinds.get(word, 0) + more
            total = np.repeat(total, length)
            more = total > n
            return v[more], w[more], shard[more], total[more]

        def rows(out: list[tuple]) -> Iterator[tuple]:
            v, w, shard, total = (np.concatenate([p[i] for p in out]) for i in range(4))
            order = np.argsort(shard, kind="stable")
            cuts = _runs(shard[order])
            salts = plan.salts_of(shard[order[cuts]])
            for a, b, several in zip(cuts, [*cuts[1:], len(order)], salts.tolist(), strict=True):
                for at in range(a, b, PIECE):
                    own = order[at : min(b, at + PIECE)]
                    data = _piece([v[own].astype(np.int64), _code_of(w[own])], [v[own], w[own]], total[own].astype(SUM_KIND))
                    for salt in range(several):
                        yield int(shard[own[0]]), salt, PAIRS, 0, len(own), data

        now, held, size, out = None, [], 0, []
        for (bucket, _), (_, _, n, data) in _groups(batches):
            if bucket != now or size > HELD_PAIRS:
                if held and bucket != now:
                    out.append(added(held))
                    held, size = [], 0
                    if sum(len(o[0]) for o in out) > HELD_PAIRS:
                        yield from _packed_batches(rows(out))
                        out = []
                elif held:
                    held, size = [_summed_pairs(held)], 0
                now = bucket
            (v, w), last = _opened(data, n, PAIR_KIND, 2)
            held.append((v, w, (last >> U64(COUNT_BITS)).astype(np.int64), (last & U64((1 << COUNT_BITS) - 1)).astype(np.int64)))
            size += n
        if held:
            out.append(added(held))
        if out:
            yield from _packed_batches(rows(out))
        yield from _packed_batches((-1, 0, WHOLE, word, n, b"") for word, n in kinds.items())

    dealt = texts.mapInArrow(met, PACKED_DDL).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(summed, PACKED_DDL)


def packed_places(texts: DataFrame, plan: Plan) -> DataFrame:
    """shard, salt, kind, base (row of the block's first text), n, data: all places, and before them in each shard that is
    split off what it is handed of its word and its counts."""
    shared = texts.sparkSession.sparkContext.broadcast(plan)

    def rows(block: pa.RecordBatch) -> Iterator[tuple]:
        plan, tokens = shared.value, tokens_of(column(block, "_text"))
        codes = plan.codes(tokens)
        keys = np.where(codes == OTHER, np.append(tokens.known, U64(0)), codes.astype(U64))
        row = column(block, "_row").to_numpy(zero_copy_only=False)
        learn = column(block, "_learn").to_numpy(zero_copy_only=False).astype(np.int64)
        text = tokens.text_of()
        u, v, w = tokens.before(2), tokens.before(1), tokens.which
        order = _order(v, u, w, len(codes))
        u, v, w, text = u[order], v[order], w[order], text[order]
        context = _runs(v, u)
        length = np.diff([*context, len(v)])
        home, shard, salts = plan.shard_of(codes[v[context]], codes[u[context]], keys[v[context]], keys[u[context]])
        split = shard != home
        by_shard = np.argsort(np.repeat(shard, length), kind="stable")
        shard, split, salts = (np.repeat(x, length)[by_shard] for x in (shard, split, salts))
        u, v, w, text = u[by_shard], v[by_shard], w[by_shard], text[by_shard]
        cuts = _runs(shard)
        for a, b in zip(cuts, [*cuts[1:], len(v)], strict=True):
            salt = int(mixed(np.array([row[0]], dtype=U64))[0] % U64(salts[a]))
            for at in range(a, b, PIECE):
                own = slice(at, min(b, at + PIECE))
                ids = [v[own], u[own], w[own]]
                last = (text[own] << 1 | learn[text[own]]).astype(TEXT_KIND)
                yield int(shard[a]), salt, PLACES, int(row[0]), len(last), _piece([codes[i] for i in ids], [keys[i] for i in ids], last)
            if split[a]:
                taught = np.flatnonzero(learn[text[a:b]] == 1) + a
                first = _runs(v[taught], u[taught], w[taught])
                n = np.diff([*first, len(taught)])
                for at in range(0, len(first), PIECE):
                    own = taught[first[at : at + PIECE]]
                    ids = [v[own], u[own], w[own]]
                    data = _piece([codes[i] for i in ids], [keys[i] for i in ids], n[at : at + PIECE].astype(COUNT_KIND))
                    for each in range(int(salts[a])):
                        yield int(shard[a]), each, COUNTS, 0, len(own), data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield from _packed_batches(rows(block))

    places = texts.mapInArrow(run, PACKED_DDL)
    if not (plan.parts > 1).any():
        return places
    pairs = written(handed_pairs(texts, plan))
    found = pairs.filter(F.col("kind") == WHOLE).groupBy("base").agg(F.sum("n").alias("n")).collect()
    kinds = {r["base"]: r["n"] for r in found}
    words = [(shard, salt, WHOLE, plan.places(v), kinds.get(v, 0), v.to_bytes(8, "little")) for shard, v in plan.splits() for salt in range(int(plan.salts_of(np.array([shard]))[0]))]
    return places.unionByName(pairs.filter(F.col("kind") == PAIRS)).unionByName(texts.sparkSession.createDataFrame(words, PACKED_DDL))


def _trie_of(pieces: list[tuple[list[np.ndarray], np.ndarray]], discount: float, handed: Handed | None = None) -> bytes:
    pieces = pieces or [([np.zeros(0, dtype=U64)] * 3, np.zeros(0, dtype=np.int64))]
    return built(*[np.concatenate([p[0][i] for p in pieces]) for i in range(3)], np.concatenate([p[1] for p in pieces]), discount, handed)


def _handed(rows: list[tuple[int, int, int, bytes]]) -> Handed | None:
    """What a shard has been handed in packed rows (kind, base, n, data), if it is split off."""
    if not rows:
        return None
    pairs = [([np.zeros(0, dtype=U64)] * 2, np.zeros(0, dtype=np.int64))] + [_opened(data, n, SUM_KIND, 2) for kind, _, n, data in rows if kind == PAIRS]
    v, total, kinds = next((int.from_bytes(data, "little"), base, n) for kind, base, n, data in rows if kind == WHOLE)
    return Handed(v, total, kinds, np.concatenate([p[0][1] for p in pairs]), np.concatenate([p[1] for p in pairs]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], tuple]]:
    """(shard, salt) and the other columns of each row, in order."""
    for batch in batches:
        columns = [column(batch, c).to_pylist() for c in ("shard", "salt", "kind", "base", "n")]
        data = column(batch, "data")
        for i, (shard, salt, kind, base, n) in enumerate(zip(*columns, strict=True)):
            yield (shard, salt), (kind, base, n, data[i].as_py())


def tries(places: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """shard, trie of packed places: the model as a table, for use outside of scored()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, learned, handed = None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None and now[1] == 0:
                yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([_trie_of(counts or learned, discount, _handed(handed))], pa.binary())], names=["shard", "trie"])

        for own, (kind, base, n, data) in _groups(batches):
            if own != now:
                yield from done()
                now, counts, learned, handed = own, [], [], []
            if kind < COUNTS:
                handed.append((kind, base, n, data))
            elif kind == COUNTS:
                counts.append(_opened(data, n, COUNT_KIND))
            elif not handed:
                learned.append(_taught(_opened(data, n, TEXT_KIND)))
        yield from done()

    return places.repartition("shard").sortWithinPartitions("shard", "salt", "kind").mapInArrow(run, "shard long, trie binary")


def _taught(piece: tuple[list[np.ndarray], np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Counts of a piece's places in training texts."""
    keys, last = piece
    own = np.flatnonzero(last & 1)
    keys = [k[own] for k in keys]
    first = _runs(*keys)
    return [k[first] for k in keys], np.diff([*first, len(own)])


#: What is known of a text: sums over its words with codes, and the number of its tokens.
SUMS = ("a", "n_tokens", "known", "logs")


class Sums:
    """Sums by text, for texts of many blocks."""

    def __init__(self) -> None:
        self.rows: dict[int, np.ndarray] = {}

    def add(self, base: int, text: np.ndarray, coded: np.ndarray, logs: np.ndarray, alone: np.ndarray) -> None:
        n, own = int(text.max()) + 1, text[coded]
        found = np.stack([np.bincount(own, logs, n), np.bincount(text, minlength=n), np.bincount(own, minlength=n), np.bincount(own, alone, n)]).astype(float)
        before = self.rows.get(base)
        if before is not None:
            longer, shorter = (found, before) if n >= before.shape[1] else (before, found)
            longer[:, : shorter.shape[1]] += shorter
            found = longer
        self.rows[base] = found

    def size(self) -> int:
        return sum(x.shape[1] for x in self.rows.values())

    def emptied(self) -> Iterator[pa.RecordBatch]:
        for base, found in self.rows.items():
            at = np.flatnonzero(found[1])
            a, n, known, logs = found[:, at]
            yield _answer_batch(base + at, None, a, None, n.astype(np.int64), known.astype(np.int64), logs)
        self.rows.clear()


def _answer_batch(row: np.ndarray, word: np.ndarray | None, a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None, known: np.ndarray | None, logs: np.ndarray | None) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.float64()]
    columns = [pa.nulls(len(row), k) if x is None else pa.array(x, k) for x, k in zip((row, word, a, b, n, known, logs), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["row", "word", "a", "b", "n_tokens", "known", "logs"])


def answer(plan: Plan, pieces: list[tuple[int, list[np.ndarray], np.ndarray]], sums: Sums, discount: float, trie: Trie | None = None) -> Iterator[pa.RecordBatch]:
    """Answers for pieces (base, keys, texts) of one shard, by its trie; without one, it is built from the places of
    training texts among them, which are then all that the shard has. The list of pieces is emptied."""
    keys = [np.concatenate([p[1][i] for p in pieces]) for i in range(3)]
    # what is not needed any more goes before the trie is built, which is when a task holds most
    bases = [(base, texts) for base, _, texts in pieces]
    pieces.clear()
    last = np.concatenate([texts for _, texts in bases])
    known, (v, u, w) = numbered(keys)
    del keys
    order, first, (v, u, w, n) = counted_runs(v, u, w, last & 1, len(known))
    if trie is None:
        taught = n > 0
        trie = Trie(packed_trie(known, v[taught], u[taught], w[taught], n[taught], discount))
        del taught
        a, b = trie.weights_of(v, u, w)
    else:
        a, b = trie.weights(known[v], known[u], known[w])
    word = known[w]
    coded = word < START
    counts = plan.counts[word[coded].astype(np.int64)] if len(plan.counts) else np.zeros(0)
    logs, alone = np.zeros(len(word)), np.zeros(len(word))
    logs[coded], alone[coded] = np.log10(a[coded] + b[coded] * plan.alone(counts, discount)), np.log10(counts + 1.0)
    which = np.empty(len(order), dtype=np.int32)
    which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    at = 0
    for base, own in bases:
        mine, text = which[at : at + len(own)], (own >> 1).astype(np.int64)
        is_coded = coded[mine]
        sums.add(base, text, is_coded, logs[mine[is_coded]], alone[mine[is_coded]])
        rest = mine[~is_coded]
        if len(rest):
            yield _answer_batch(base + text[~is_coded], word[rest].view(np.int64), a[rest], b[rest], None, None, None)
        at += len(own)


def answered(places: DataFrame, plan: Plan, discount: float = DISCOUNT) -> DataFrame:
    """row, word, a, b, n_tokens, known, logs: of each text the sums over its coded words (word null): log10 of their
    probabilities as a, how many tokens and how many coded ones there are, log10 of their counts and one; and for each
    place of another word the numbers of which a + b * p(word) is its probability."""
    shared = places.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, counts, held, sums, handed = None, None, [], [], Sums(), []

        def finish() -> Iterator[pa.RecordBatch]:
            if held:
                opened = [(base, *_opened(data, n, TEXT_KIND)) for base, n, data in held]
                held.clear()
                yield from answer(shared.value, opened, sums, discount, trie)

        for own, (kind, base, n, data) in _groups(batches):
            if own != now:
                yield from finish()
                now, trie, counts, held, handed = own, None, [], [], []
            if sums.size() > MOST_SUMS:
                yield from sums.emptied()
            if kind < COUNTS:
                handed.append((kind, base, n, data))
                continue
            if kind == COUNTS:
                counts.append(_opened(data, n, COUNT_KIND))
                if len(counts) == 256:
                    counts = [_merged(counts)]
                continue
            if handed:
                trie, counts, handed = Trie(_trie_of(counts, discount, _handed(handed))), [], []
            held.append((base, n, data))
            if trie is not None and len(held) == 32:
                yield from finish()
                held = []
        yield from finish()
        yield from sums.emptied()

    dealt = places.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInArrow(run, "row long, word long, a double, b double, n_tokens long, known long, logs double")


def _merged(counts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    keys, n = [np.concatenate([c[0][i] for c in counts]) for i in range(3)], np.concatenate([c[1] for c in counts]).astype(np.int64)
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = _runs(*keys)
    return [k[first] for k in keys], np.add.reduceat(n[order], first)


def scored(docs: DataFrame, learn: Column, text: str = "text", discount: float = DISCOUNT, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The rows of docs as a struct doc, with n_tokens, n_known, train_tokens, base_score, score."""
    row, doc = "_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered_docs = docs.select(F.monotonically_increasing_id().alias(row), F.col(f"`{text}`").cast("string").alias("_text"), F.coalesce(learn, F.lit(False)).alias("_learn"), doc.alias("doc"))
    texts = numbered_docs.select(row, "_text", "_learn")
    counts = written(counted(texts))
    plan = planned(counts, shard_tokens)
    answers = written(answered(packed_places(texts, plan), plan, discount))
    c = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    total, distinct = float(plan.total), float(plan.distinct)
    alone = F.greatest(c - discount, F.lit(0.0)) / total + discount * distinct / total / (distinct + 1) if plan.total else F.lit(1.0 / (distinct + 1))
    rare = answers.filter("word IS NOT NULL").join(counts.filter("other IS NULL").select("word", "n"), "word", "left")
    one = rare.select("row", F.log10(F.col("a") + F.col("b") * alone).alias("a"), F.lit(0).cast("long").alias("n_tokens"), (c > 0).cast("long").alias("known"), F.log10(c + 1).alias("logs"))
    sums = one.unionByName(answers.filter("word IS NULL").select("row", *SUMS)).groupBy(F.col("row").alias(row)).agg(*[F.sum(x).alias(f"_{x}") for x in SUMS])
    return numbered_docs.select(row, "doc").join(sums, row).select(
        "doc",
        F.col("_n_tokens").alias("n_tokens"),
        F.col("_known").alias("n_known"),
        F.lit(plan.total).cast("long").alias("train_tokens"),
        (F.col("_logs") - F.col("_n_tokens") * F.log10(F.lit(total + distinct + 1))).alias("base_score"),
        F.col("_a").alias("score"),
    )


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op13_elias_fano_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of those whose id's checksum leaves another remainder than 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scored(docs, ~held_out("doc_id"))
    return found.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
