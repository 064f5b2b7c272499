"""Helpers that the training-data operators share: the shared folder, and hashed words of Arrow text columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Bytes of text that one numpy step takes at once; a longer text makes a step of its own.
SLICE_BYTES = 2_000_000

U64 = np.uint64
_RADIX = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93 | 1
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)

_ASCII = np.arange(256)
#: Letters and digits of ASCII and every byte of other characters: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower case.
ALNUM = ((_ASCII >= 48) & (_ASCII <= 57)) | ((_ASCII >= 97) & (_ASCII <= 122)) | ((_ASCII >= 65) & (_ASCII <= 90)) | (_ASCII >= 128)
#: Words `[^\x20\x09-\x0D]+`.
NONSPACE = ~((_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13)))
LOWER = np.where((_ASCII >= 65) & (_ASCII <= 90), _ASCII + 32, _ASCII).astype(np.uint8)
SAME = _ASCII.astype(np.uint8)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where a local session names none, a local one is set; on a cluster a
    missing name is an error, since executors would not see each other's files."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: read again by later steps instead of being computed again."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _powers(radix: int, n: int, cache: dict) -> np.ndarray:
    """radix ** 0 .. radix ** (n - 1) modulo 2 ** 64."""
    have = cache.get(radix)
    if have is None or len(have) < n:
        size = 1 << max(10, int(n).bit_length())
        have = np.full(size, radix, dtype=U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 21:  # 16 MB; longer ones are made anew
            cache[radix] = have
    return have[:n]


_CACHE: dict = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def weights(n: int, seed: int) -> np.ndarray:
    """n odd numbers that follow no rule a text could meet: one for each place in a word or window."""
    return mixed(np.arange(1, n + 1, dtype=U64) * U64(seed)) | U64(1)


@lru_cache(maxsize=64)
def _steps(k: int) -> np.ndarray:
    return weights(k, _STEP)


def spans_hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[s:e] for each of some spans, in order and apart: the sum of each value times the weight of
    its place in the span. Powers of one number would not do for weights: modulo 2 ** 64 strings of two letters that are
    built from one another by exchange (Thue-Morse) have equal sums whatever the number."""
    length = ends - starts
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    total = np.zeros(len(place) + 1, dtype=U64)
    np.cumsum(values[place + np.repeat(starts, length)] * weights(int(length.max(initial=0)), _RADIX)[place], out=total[1:])
    until = np.cumsum(length)
    return mixed(total[until] - total[until - length] + length.astype(U64))


@dataclass
class Words:
    """The words of some texts. Word i lies in bytes[starts[i]:ends[i]]; text t has words first[t]:first[t + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words of one text, and the windows' hashes."""
        n = self.counts()
        last = np.repeat(self.first[1:], n)
        at = np.flatnonzero(np.arange(len(self.hashes)) + k <= last)
        return at, self.window_hashes(at, k)

    def window_hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        total = np.full(len(at), k, dtype=U64)
        for place, weight in enumerate(_steps(k)):
            total += self.hashes[at + place] * weight
        return mixed(total)


def words_of(texts: pa.Array, kind: np.ndarray, fold: np.ndarray = SAME) -> Words:
    """Words as maximal runs of bytes of a kind; fold is applied to each byte first. A null text has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[base:end]
    offsets = offsets - base
    data = fold[data]
    inside = kind[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    if len(data):
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.concatenate((inside[1:], [False]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    else:
        starts = ends = np.zeros(0, dtype=np.int64)
    first = np.searchsorted(starts, offsets, side="left")
    return Words(data, starts, ends, first, spans_hashed(_BYTE[data], starts, ends))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of batch whose texts have about limit bytes together."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def extended(df: DataFrame, more: str) -> StructType:
    """The schema of df's columns, whatever their names, and of those that the DDL string more adds."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields] + StructType.fromDDL(more).fields)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
