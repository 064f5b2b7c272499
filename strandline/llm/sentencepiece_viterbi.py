"""SentencePiece encoding and decoding by a Viterbi pass over a trie of distinct words.

Text becomes words that carry their space marks. A batch's distinct new words are sorted, which lays them out as a trie
in depth-first order: each word keeps the forward states of the prefix that it shares with the word before and only
advances from there. A state holds, for one prefix, its best last piece (and score).

The transitions follow the model's kind. A unigram model adds scores and keeps the largest sum. A merge (BPE) model has
no sums: its result is what merging by rank leaves. There a piece may follow another exactly if merging both together
leaves the two apart; of all pieces that end a prefix just one can follow the state where it starts, since a chain of
pieces is the merged form exactly if each neighbouring pair is. So the same pass gives the library's ids.

The vocabulary is read on the driver and broadcast: its size is the model's. Words already encoded are kept by each
Python worker, up to KEPT_BYTES of memory in two halves, of which the older one is dropped. Nothing is shuffled.

Defined cases: a null text has null ids and decodes to null; an empty one has none; a very long text is read whole, and so
is a word of any length; an empty table gives no rows; columns of the result's names are replaced, others stay; a character outside the vocabulary
becomes its UTF-8 bytes, or the unknown id if the model has no bytes; the mark U+2581 in a text is read as a space, the
one case (besides unknown ids) in which decoding does not give the text back; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import column, extended, slices

MARK = "▁"
#: Memory, in bytes (about), of the words of one worker whose ids are kept, and words beside them.
KEPT_BYTES = 64_000_000
KEPT_WORDS = 100_000
#: What a kept word takes beside its letters and ids: its tuple and its place in a dictionary.
WORD_BYTES = 160
SLICE = 1_000_000


def splitter(pieces: Collection[str]) -> re.Pattern[str]:
    """Words of marked text: space marks and letters, or space marks and other characters, or marks alone. No piece of
    the vocabulary may lie across two words, so characters that pieces join to letters count as letters."""
    odd = {c for p in pieces for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}  # such as a raised two
    joined: set[str] = set()
    while True:
        apart, more_letters = re.escape("".join(sorted(odd))), re.escape("".join(sorted(joined)))
        letter = rf"[^\W\d_{apart}]" if not joined else rf"(?:[^\W\d_{apart}]|[{more_letters}])"
        other = rf"(?:[\d_{apart}]|(?!{MARK})\W)" if not joined else rf"(?:(?![{MARK}{more_letters}])[\W\d_{apart}])"
        word = re.compile(rf"{MARK}*{letter}+|{MARK}*{other}+|{MARK}+")
        parts = [found for p in pieces if len(found := word.findall(p)) > 1]
        if not parts:
            return word
        more = {c for found in parts for x, y in zip(found, found[1:], strict=False) for c in (x[-1], y[0]) if c != MARK and not c.isalpha()} - joined
        if not more:
            return re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
        joined |= more
        odd -= more


@dataclass
class Vocabulary:
    """pieces: id and score of each normal piece; texts: what each id decodes to; bytes_at: ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, float]]
    texts: list[bytes]
    unknown: int
    bytes_at: list[int]
    merges: bool
    prefix: bool
    stable: dict[int, dict[int, bool]] = field(default_factory=dict)
    kept: dict[str, tuple[int, ...]] = field(default_factory=dict)
    older: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.worst = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        self.word = splitter(self.pieces)
        # every prefix of a piece: the piece's number, or -1 if it is a prefix only; numbers over the pieces' are
        # single characters that are no piece
        self.names: list[str] = list(self.pieces)
        self.table: dict[str, int] = {p[:k]: -1 for p in self.names for k in range(1, len(p))}
        self.table |= {p: i for i, p in enumerate(self.names)}
        self.known_ids = [self.pieces[p][0] for p in self.names]
        self.pairs = 0
        self.kept_bytes = 0
        self.sums = [self.pieces[p][1] for p in self.names]
        self.strange: dict[str, int] = {}

    def number(self, character: str) -> int:
        """The number of a single character, which always ends a prefix."""
        known = self.table.get(character, -1)
        if known < 0:
            known = self.strange.get(character, -1)
            if known < 0:
                known = self.strange[character] = len(self.names)
                self.names.append(character)
        return known

    def recalled(self, words: Collection[str]) -> dict[str, tuple[int, ...]]:
        """Kept ids of words. What is used again stays when the older half is dropped."""
        kept, older, found = self.kept, self.older, {}
        for word in words:
            own = kept.get(word)
            if own is None:
                own = older.get(word)
                if own is None:
                    continue
                self.keep(word, own)
                kept = self.kept
            found[word] = own
        return found

    def keep(self, word: str, ids: tuple[int, ...]) -> None:
        """ids of a word, kept in the newer half; a full one becomes the older half."""
        self.kept[word] = ids
        self.kept_bytes += getsizeof(word) + 8 * len(ids) + WORD_BYTES
        if self.kept_bytes > KEPT_BYTES // 2:
            self.older, self.kept, self.kept_bytes = self.kept, {}, 0

    def merged(self, text: str) -> list[str]:
        """Characters merged by rank: the best scored joinable pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                known = self.pieces.get(parts[i] + parts[i + 1])
                if known is not None and (best is None or known[1] > best):
                    best, at = known[1], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: int, piece: int) -> bool:
        """Whether merging leaves the two pieces apart (before -1: the piece stands alone)."""
        left, right = self.names[before] if before >= 0 else "", self.names[piece]
        known = self.stable[before][piece] = self.merged(left + right) == ([left, right] if left else [right])
        self.pairs += 1
        return known

    def ids(self, numbers: list[int]) -> tuple[int, ...]:
        known = self.known_ids
        if max(numbers) < len(known):
            return tuple([known[n] for n in numbers])
        out: list[int] = []
        for n in numbers:
            if n < len(known):
                out.append(known[n])
            elif self.bytes_at:
                out.extend(self.bytes_at[b] for b in self.names[n].encode("utf-8", "replace"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return tuple(out)


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file whose text normalisation is the identity."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec, kind = model.normalizer_spec, model.trainer_spec.model_type
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix or kind not in (1, 2):
        raise ValueError(f"{path}: only unigram and BPE models without text normalisation can be read")
    normal, user, byte, unknown = 1, 4, 6, 2
    pieces, texts, bytes_at, unknown_id = {}, [], [-1] * 256, 0
    for i, p in enumerate(model.pieces):
        if p.type in (normal, user):
            pieces[p.piece] = (i, p.score)
            texts.append(p.piece.replace(MARK, " ").encode())
        elif p.type == byte:
            value = int(p.piece[3:5], 16)
            bytes_at[value] = i
            texts.append(bytes([value]))
        else:
            unknown_id = i if p.type == unknown else unknown_id
            texts.append(" ⁇ ".encode() if p.type == unknown else b"")
    return Vocabulary(pieces, texts, unknown_id, bytes_at if min(bytes_at) >= 0 else [], kind == 2, spec.add_dummy_prefix)


def _shared(word: str, before: str) -> int:
    """Characters at the start that two words have in common."""
    same = 0
    for x, y in zip(word, before, strict=False):
        if x != y:
            break
        same += 1
    return same


def _merged_words(vocabulary: Vocabulary, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
    """Depth first over the trie of sorted words. Of each prefix of the word before the pass keeps its last piece, where
    that starts, what may follow it, and where pieces that may still grow have begun."""
    get, stable = vocabulary.table.get, vocabulary.stable
    last, begin, after, growing = [-1], [0], [stable.setdefault(-1, {})], [()]
    before = ""
    for word in words:
        same = _shared(word, before)
        del last[same + 1 :], begin[same + 1 :], after[same + 1 :], growing[same + 1 :]
        for i in range(same, len(word)):
            end, chosen, start, alive = i + 1, -1, i, []
            for j in growing[i]:
                n = get(word[j:end])
                if n is None:
                    continue
                alive.append(j)
                if n >= 0 and chosen < 0:
                    fits = after[j].get(n)
                    if fits is None:
                        fits = vocabulary.follows(last[j], n)
                    if fits:
                        chosen, start = n, j
            own = get(word[i])
            if own is not None:
                alive.append(i)
            if chosen < 0:  # the one piece left is the character
                chosen = own if own is not None and own >= 0 else vocabulary.number(word[i])
            last.append(chosen)
            begin.append(start)
            growing.append(alive)
            row = stable.get(chosen)
            if row is None:
                row = stable[chosen] = {}
            after.append(row)
        back, i = [], len(word)
        while i:
            back.append(last[i])
            i = begin[i]
        back.reverse()
        before = word
        yield word, vocabulary.ids(back)
    if vocabulary.pairs > 4 * KEPT_WORDS:
        stable.clear()
        vocabulary.pairs = 0


def _summed_words(vocabulary: Vocabulary, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
    """The same pass with scores: of each prefix, the largest sum of its pieces' scores."""
    get, sums = vocabulary.table.get, vocabulary.sums
    last, begin, score, growing = [-1], [0], [0.0], [()]
    before = ""
    for word in words:
        same = _shared(word, before)
        del last[same + 1 :], begin[same + 1 :], score[same + 1 :], growing[same + 1 :]
        for i in range(same, len(word)):
            own = get(word[i])
            single = own is not None and own >= 0
            chosen, start, alive = own if single else vocabulary.number(word[i]), i, []
            best = score[i] + (sums[own] if single else vocabulary.worst)
            for j in growing[i]:
                n = get(word[j : i + 1])
                if n is not None:
                    alive.append(j)
                    if n >= 0 and score[j] + sums[n] > best:
                        chosen, start, best = n, j, score[j] + sums[n]
            if own is not None:
                alive.append(i)
            last.append(chosen)
            begin.append(start)
            score.append(best)
            growing.append(alive)
        back, i = [], len(word)
        while i:
            back.append(last[i])
            i = begin[i]
        back.reverse()
        before = word
        yield word, vocabulary.ids(back)


def encoded_words(vocabulary: Vocabulary, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
    """Ids of sorted distinct words."""
    yield from (_merged_words if vocabulary.merges else _summed_words)(vocabulary, words)
    if len(vocabulary.names) > len(vocabulary.pieces) + KEPT_WORDS:
        del vocabulary.names[len(vocabulary.pieces) :]
        vocabulary.strange.clear()
        vocabulary.stable.clear()


def _encoded(vocabulary: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and where each text's begin."""
    split = []
    for text in texts:
        marked = (MARK * vocabulary.prefix + text.replace(" ", MARK)) if text else ""
        split.append(vocabulary.word.findall(marked))
    distinct = set(chain.from_iterable(split))
    found = vocabulary.recalled(distinct)
    new = sorted(w for w in distinct if w not in found)
    for word, own in encoded_words(vocabulary, new):
        found[word] = own
        vocabulary.keep(word, own)
    number = dict(zip(found, range(len(found)), strict=True))
    ids = list(found.values())
    sizes = list(map(len, ids))
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32)
    sizes = np.array(sizes, dtype=np.int64)
    heads = np.cumsum(sizes) - sizes
    used = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), dtype=np.int64)
    length = sizes[used]
    ends = np.cumsum(length)
    out = flat[np.repeat(heads[used] - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)] if len(used) else flat[:0]
    words_through = np.cumsum([0, *map(len, split)])
    return out, np.concatenate(([0], ends))[words_through]


def _decoded(vocabulary: Vocabulary, ids: np.ndarray, first: np.ndarray) -> list[str]:
    size = np.array([len(t) for t in vocabulary.texts], dtype=np.int64)
    flat = np.frombuffer(b"".join(vocabulary.texts), dtype=np.uint8)
    heads = np.cumsum(size) - size
    length = size[ids]
    ends = np.concatenate(([0], np.cumsum(length)))
    data = flat[np.repeat(heads[ids] - ends[:-1], length) + np.arange(int(ends[-1]))].tobytes()
    out = []
    for a, b in zip(ends[first[:-1]].tolist(), ends[first[1:]].tolist(), strict=True):
        own = data[a:b]
        out.append((own[1:] if vocabulary.prefix and own[:1] == b" " else own).decode("utf-8", "replace"))
    return out


def encoded(docs: DataFrame, model: str, text: str = "text", decode: bool = True) -> DataFrame:
    """docs with ids and, from those ids, decoded; columns of these names are replaced."""
    docs = docs.drop("ids", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE):
                texts = column(part, text).to_pylist()
                ids, first = _encoded(vocabulary, texts)
                absent = np.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=pa.array(absent))
                more, names = [lists], ["ids"]
                if decode:
                    back = [None if t is None else d for t, d in zip(texts, _decoded(vocabulary, ids, first), strict=True)]
                    more.append(pa.array(back, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *names])

    return docs.mapInArrow(run, extended(docs, "ids array<int>" + ", decoded string" * decode))


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every document under the public 32,000-piece model, and whether they decode to the text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = encoded(docs, default_model())
    return found.selectExpr("doc_id", "cast(size(ids) as bigint) AS n_tokens", "ids", "decoded <=> text AS round_trip")
