"""Language of text by a linear-chain conditional random field over words.

Each word has affix, character n-gram, whole-word and lexicon features, hashed into one table of weights for each
language; learned transitions tie neighbouring words. Forward-backward gives every word its probabilities, so a text
that switches language is labelled word by word; a document gets the language with the largest mean probability.

The field is fitted in one task, on a bounded sample of labelled rows: of each language the SAMPLE_TEXTS texts with the
smallest hash, those of up to SAMPLE_BYTES first, then the shortest (a language of long texts only has a sample too),
and LANGUAGE_BYTES of text together, or one text. Equal texts count once, so copies change nothing. Every language that
has a text with words is learned. Sequences that splice spans of different languages teach the transitions by their
whole gradient. The fitted table (TABLE weights a language) is broadcast; prediction reads every whole text.

Beside the prediction stands known, the share of the three-byte sequences of a text's words without digits that the
sample has: a text in a language that was not learned, or junk of letters, has few. A text without any has 1.

Defined cases: a null text or one without letters is `und` with score 0, and so is everything if nothing can be
learned; ties go to the language that sorts first; a very long text is one chain of words, whose features are laid out
DISTINCT distinct words at a time; repeated rows get equal results; columns of the result's names are replaced, others
stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import _BYTE, _CACHE, _RADIX, ALNUM, LOWER, Words, _powers, column, extended, mixed, slices, words_of

SAMPLE_TEXTS = 300
SAMPLE_BYTES = 32_768
LANGUAGE_BYTES = 2_000_000
TABLE = 1 << 18
#: Words of a spliced training sequence, mean words of one span, and sequences for each language.
SEQUENCE, SPAN, SEQUENCES = 64, 24, 400
EPOCHS, BATCH, RATE = 3, 128, 0.5
AFFIXES = (1, 2, 3, 4)
#: A word is in the lexicon if the sample has it so often, and this share of it in one language.
LEXICON_COUNT, LEXICON_SHARE = 3, 0.8
#: Text of one numpy step, and distinct words whose features are laid out at once.
SLICE = 1_500_000
DISTINCT = 20_000
UNKNOWN = "und"


@dataclass
class Field:
    """Labels, weights (TABLE x labels), log transitions, log start, the lexicon (word hashes and their labels), and
    which entries of a table hold a three-letter sequence of the sample."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    lexicon: np.ndarray
    lexicon_label: np.ndarray
    grams: np.ndarray


class _Spans:
    """Hashes of byte ranges of some words' texts."""

    def __init__(self, words: Words) -> None:
        self.total = np.zeros(len(words.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[words.data] * _powers(_RADIX, len(words.data), _CACHE), out=self.total[1:])
        self.undo = _powers(pow(_RADIX, -1, 1 << 64), len(words.data) + 1, _CACHE)

    def entries(self, kind: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.total[b] - self.total[a]) * self.undo[a] + np.uint64(kind * 7919)) % np.uint64(TABLE)


def _grams(spans: _Spans, starts: np.ndarray, size: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word (place in starts) and table entry of every k-gram of bytes."""
    many = np.maximum(size - k + 1, 0)
    row = np.repeat(np.arange(len(starts)), many)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(len(row))
    return row, spans.entries(30 + k, first, first + k)


def _features(words: Words, spans: _Spans, at: np.ndarray, lexicon: np.ndarray, lexicon_label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row (place in at) and table entry of every feature of the words at."""
    starts, ends = words.starts[at], words.ends[at]
    size = ends - starts
    everyone = np.arange(len(at))
    rows, entries = [everyone], [spans.entries(1, starts, ends)]
    for k in AFFIXES:
        row = np.flatnonzero(size > k)
        rows += [row, row]
        entries += [spans.entries(10 + k, starts[row], starts[row] + k), spans.entries(20 + k, ends[row] - k, ends[row])]
    for k in (2, 3):
        row, entry = _grams(spans, starts, size, k)
        rows.append(row)
        entries.append(entry)
    if len(lexicon):
        hashes = words.hashes[at]
        place = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        row = np.flatnonzero(lexicon[place] == hashes)
        rows.append(row)
        entries.append(_lexicon_entries(lexicon_label[place[row]]))
    return np.concatenate(rows), np.concatenate(entries).astype(np.int64)


def _lexicon_entries(label: np.ndarray) -> np.ndarray:
    return mixed(label.astype(np.uint64) + np.uint64(40 * 7919)) % np.uint64(TABLE)


def _scores(rows: np.ndarray, entries: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(rows, weights=weights[entries, y], minlength=n) for y in range(weights.shape[1])], axis=1)


def _marginals(emit: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over sequences first[s]:first[s + 1] of log scores, all sequences in step, longest first.
    Gives every word's label probabilities, and the expected number of moves between labels."""
    potential = np.exp(emit - emit.max(axis=1, keepdims=True))
    step, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    heads, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences longer than t
    ahead = np.empty_like(potential)
    now = None
    for t in range(longest):
        at = heads[: active[t]] + t
        now = begin * potential[at] if t == 0 else (now[: active[t]] @ step) * potential[at]
        now = now / now.sum(axis=1, keepdims=True)
        ahead[at] = now
    pairs = np.zeros_like(step)
    back = np.zeros((0, potential.shape[1]))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = heads[:n] + t
        if len(back) < n:
            back = np.concatenate((back, np.ones((n - len(back), potential.shape[1]))))
        now = ahead[at] * back
        seen = potential[at] * back
        if t:
            before = ahead[at - 1]
            # before[n, i] * step[i, j] * seen[n, j], each n divided by its sum
            whole = ((before @ step) * seen).sum(axis=1, keepdims=True)
            pairs += step * ((before / whole).T @ seen)
        ahead[at] = now / now.sum(axis=1, keepdims=True)
        if t:
            back = seen @ step.T
            back = back / back.max(axis=1, keepdims=True)
    return ahead, pairs


def _features_of(batch: pa.RecordBatch, wanted: np.ndarray, lexicon: np.ndarray, lexicon_label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row (place in wanted, ascending) and table entry of the features of the words with the wanted hashes."""
    rows, entries = [], []
    done = np.zeros(len(wanted), dtype=bool)
    for part in slices(batch, "text", SLICE):
        words = words_of(column(part, "text"), ALNUM, LOWER)
        place = np.minimum(np.searchsorted(wanted, words.hashes), len(wanted) - 1)
        at = np.flatnonzero((wanted[place] == words.hashes) & ~done[place])
        place, first = np.unique(place[at], return_index=True)
        if len(place):
            row, entry = _features(words, _Spans(words), at[first], lexicon, lexicon_label)
            rows.append(place[row].astype(np.int32))
            entries.append(entry.astype(np.int32))
            done[place] = True
    row, entry = np.concatenate(rows), np.concatenate(entries)
    order = np.argsort(row, kind="stable")
    return row[order], entry[order]


def fitted(texts: list[str], langs: list[str]) -> Field | None:
    """The field of a sample of labelled texts; the same for the same sample. Texts are read about SLICE bytes at a time;
    what stays is a hash for each word and the features of each distinct word."""
    names = sorted(set(langs))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([names.index(x) for x in langs], pa.int32())], ["text", "lang"])
    none = np.zeros(0, dtype=np.uint64)
    own_hashes, own_labels, seen = [none], [none.astype(np.int64)], none
    grams = np.zeros(TABLE, dtype=bool)
    for part in slices(batch, "text", SLICE):
        words = words_of(column(part, "text"), ALNUM, LOWER)
        own_hashes.append(words.hashes)
        own_labels.append(np.repeat(column(part, "lang").to_numpy().astype(np.int64), words.counts()))
        found, at = np.unique(words.hashes, return_index=True)
        fresh = ~np.isin(found, seen, assume_unique=True)
        if fresh.any():
            at = at[fresh]
            grams[_grams(_Spans(words), words.starts[at], words.ends[at] - words.starts[at], 3)[1]] = True
            seen = np.concatenate((seen, found[fresh]))
    hashes, label = np.concatenate(own_hashes), np.concatenate(own_labels)
    if not len(hashes):
        return None
    used = np.unique(label)
    labels = [names[y] for y in used.tolist()]  # languages whose texts have words
    label, size = np.searchsorted(used, label), len(labels)
    seen = np.sort(seen)
    which = np.searchsorted(seen, hashes)
    counts = np.stack([np.bincount(which[label == y], minlength=len(seen)) for y in range(size)], axis=1)
    sure = np.flatnonzero((counts.sum(axis=1) >= LEXICON_COUNT) & (counts.max(axis=1) >= LEXICON_SHARE * counts.sum(axis=1)))
    lexicon, lexicon_label = seen[sure], counts.argmax(axis=1)[sure]

    rng = np.random.default_rng(7)
    own = [np.flatnonzero(label == y) for y in range(size)]
    chains, gold = [], []
    for _ in range(SEQUENCES * size):
        at, y = [], []
        while len(at) < SEQUENCE:
            lang = int(rng.integers(size))
            span = 1 + int(rng.geometric(1 / SPAN))
            head = int(rng.integers(len(own[lang])))
            taken = own[lang][head : head + span]
            at.extend(taken.tolist())
            y.extend([lang] * len(taken))
        chains.append(which[at[:SEQUENCE]])
        gold.append(y[:SEQUENCE])
    chains, gold = np.array(chains), np.array(gold)

    # features of the words that the sequences hold
    kept, chains = np.unique(chains, return_inverse=True)
    chains = chains.reshape(len(gold), SEQUENCE)
    rows, entries = _features_of(batch, seen[kept], lexicon, lexicon_label)
    pointer = np.searchsorted(rows, np.arange(len(kept) + 1, dtype=np.int32))

    weights = np.zeros((TABLE, size))
    moves, start = np.zeros((size, size)), np.zeros(size)
    spread, move_spread = np.full(TABLE, 1e-6), 1e-6
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // BATCH)):
            used, place = np.unique(chains[batch], return_inverse=True)
            place = place.reshape(-1)
            lengths = pointer[used + 1] - pointer[used]
            row = np.repeat(np.arange(len(used)), lengths)
            entry = entries[np.repeat(pointer[used] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(len(row))]
            emit = _scores(row, entry, len(used), weights)[place]
            n = len(batch)
            expected, pairs = _marginals(emit, np.arange(n + 1) * SEQUENCE, moves, start)
            y = gold[batch]
            wrong = -expected
            wrong[np.arange(n * SEQUENCE), y.reshape(-1)] += 1
            by_word = np.stack([np.bincount(place, weights=wrong[:, c], minlength=len(used)) for c in range(size)], axis=1)
            touched, slot = np.unique(entry, return_inverse=True)
            slope = np.stack([np.bincount(slot, weights=by_word[row, c], minlength=len(touched)) for c in range(size)], axis=1) / n
            spread[touched] += (slope**2).mean(axis=1)
            weights[touched] += RATE * slope / np.sqrt(spread[touched])[:, None] * 0.3
            seen = np.zeros_like(pairs)
            np.add.at(seen, (y[:, :-1].reshape(-1), y[:, 1:].reshape(-1)), 1)
            turn = (seen - pairs) / n
            move_spread += (turn**2).mean()
            moves += RATE * turn / np.sqrt(move_spread) * 0.3
    return Field(labels, weights.astype(np.float32), moves, start, lexicon, lexicon_label, grams)


def sampled(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, text: the sample of every language. Only hashes and lengths are shuffled until the sample is known."""
    rows = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    marked = rows.withColumn("hash", F.xxhash64("text")).withColumn("size", F.octet_length("text").cast("long"))
    texts = marked.groupBy("lang", "hash").agg(F.min("size").alias("size"))
    order = Window.partitionBy("lang").orderBy(F.greatest("size", F.lit(SAMPLE_BYTES)), "hash")
    first = texts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_TEXTS)
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = first.withColumn("through", before).filter((F.col("place") == 1) | (F.col("through") <= LANGUAGE_BYTES))
    # SAMPLE_TEXTS rows a language
    return marked.join(F.broadcast(kept.select("lang", "hash")), ["lang", "hash"], "left_semi").dropDuplicates(["lang", "hash"]).select("lang", "hash", "text")


def learned(train: DataFrame, text: str = "text", lang: str = "lang") -> Field | None:
    """The field of rows (text, lang), fitted by one task on the bounded sample; a null in either teaches nothing."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = list(frames)
        if sample:
            rows = pd.concat(sample).sort_values(["lang", "hash", "text"])
            field = fitted(rows["text"].tolist(), rows["lang"].tolist())
            if field is not None:
                yield pd.DataFrame({"field": [pickle.dumps(field)]})

    found = sampled(train, text, lang).coalesce(1).mapInPandas(run, "field binary").collect()
    return pickle.loads(found[0]["field"]) if found else None


RESULT = ("lang_pred", "score", "known")


def predicted(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and known; columns of these names are replaced."""
    docs = docs.drop(*RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE):
                words = words_of(column(part, text), ALNUM, LOWER)
                best, score, known = [UNKNOWN] * len(part), np.zeros(len(part)), np.zeros(len(part))
                if crf is not None and len(words.hashes):
                    _, first_at, which = np.unique(words.hashes, return_index=True, return_inverse=True)
                    spans = _Spans(words)
                    digits = np.concatenate(([0], np.cumsum((words.data >= 48) & (words.data <= 57))))
                    emits, have, many = [], [], []
                    for a in range(0, len(first_at), DISTINCT):
                        at = first_at[a : a + DISTINCT]
                        emits.append(_scores(*_features(words, spans, at, crf.lexicon, crf.lexicon_label), len(at), crf.weights))
                        letters = np.flatnonzero(digits[words.ends[at]] == digits[words.starts[at]])
                        row, entry = _grams(spans, words.starts[at[letters]], (words.ends - words.starts)[at[letters]], 3)
                        row = letters[row]
                        have.append(np.bincount(row, weights=crf.grams[entry], minlength=len(at)))
                        many.append(np.bincount(row, minlength=len(at)))
                    likely, _ = _marginals(np.concatenate(emits)[which], words.first, crf.moves, crf.start)
                    per_text = lambda x: np.diff(np.concatenate((np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)))[words.first], axis=0)
                    mean = per_text(likely) / np.maximum(words.counts(), 1)[:, None]
                    have, many = per_text(np.concatenate(have)[which]), per_text(np.concatenate(many)[which].astype(float))
                    known = np.where(many > 0, have / np.maximum(many, 1), 1.0)
                    top = mean.argmax(axis=1)
                    letters = np.concatenate(([0], np.cumsum((words.data >= 97) & (words.data <= 122))))
                    edges = np.concatenate((words.starts, [len(words.data)]))[np.minimum(words.first, len(words.starts))]
                    plain = letters[edges[1:]] - letters[edges[:-1]]
                    for t in range(len(part)):
                        if words.first[t] < words.first[t + 1] and (plain[t] or any(map(str.isalpha, column(part, text)[t].as_py()))):
                            best[t], score[t] = crf.labels[top[t]], min(1.0, max(0.0, mean[t, top[t]]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best, pa.string()), pa.array(score), pa.array(known)], [*part.schema.names, *RESULT])

    return docs.mapInArrow(run, extended(docs, "lang_pred string, score double, known double"))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op9_crf_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = learned(docs.filter(~held_out()))
    found = predicted(docs.select("doc_id", held_out().alias("held_out"), "text"), field)
    return found.select("doc_id", "held_out", "lang_pred", "score", "known")
