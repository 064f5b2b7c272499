"""Global alignment of pairs of sequences in a band, many pairs at once, and what is told by it: identity and coverage.

A cell of the matrix is one 64-bit number, of which the upper part is the score, then the identical and the aligned pairs
so far; steps add numbers of that form, so the largest sum is the best score and, among equal ones, the alignment with
most identical and then most aligned pairs. No path is stored: memory is one row of the band. The band grows until no
path outside it can reach the score that was found, so the result is that of the whole matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Half width of the first band, cells of one row of all pairs of a step, and bits of each count.
BAND, CELLS, BITS = 16, 1 << 16, 20
LOWEST = np.int64(-(1 << 62))


def _codes(texts: list[str], width: int) -> np.ndarray:
    out = np.full((len(texts), width), -1, dtype=np.int32)
    for i, text in enumerate(texts):
        out[i, : len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype="<i4")
    return out


def banded(sources: list[str], targets: list[str], half: int, match: int, mismatch: int, gap: int) -> np.ndarray:
    """The best number of each pair within a band of half diagonals on either side of those between its corners."""
    m, n = np.array([len(s) for s in sources]), np.array([len(t) for t in targets])
    a, b = _codes(sources, max(1, int(m.max()))), _codes(targets, max(1, int(n.max())))
    low = np.minimum(0, n - m) - half
    width = int((np.abs(n - m) + 2 * half + 1).max())
    k = np.arange(width)[None, :]
    own = k < (np.abs(n - m) + 2 * half + 1)[:, None]
    unit = np.int64(1) << (2 * BITS)
    same, other, step = np.int64(match) * unit + (1 << BITS) + 1, np.int64(mismatch) * unit + 1, np.int64(gap) * unit
    j = low[:, None] + k
    row = np.where((j >= 0) & (j <= n[:, None]) & own, j * step, LOWEST)
    out, bare = np.zeros(len(m), dtype=np.int64), np.flatnonzero(m == 0)
    out[bare] = row[bare, (n - low)[bare]]
    slope = k * step
    for i in range(1, int(m.max()) + 1):
        j = i + low[:, None] + k
        valid = (j >= 0) & (j <= n[:, None]) & own
        letter = np.take_along_axis(b, np.clip(j - 1, 0, b.shape[1] - 1), axis=1)
        through = np.where(j >= 1, row + np.where(letter == a[:, i - 1 : i], same, other), LOWEST)
        down = np.full_like(row, LOWEST)
        down[:, :-1] = row[:, 1:] + step
        best = np.where(valid, np.maximum(through, down), LOWEST)
        # along the row: the best of what lies before, a gap for each column
        row = np.where(valid, np.maximum.accumulate(np.where(valid, best - slope, LOWEST), axis=1) + slope, LOWEST)
        done = m == i
        if done.any():
            out[done] = row[done, (n - m - low)[done]]
    return out


def aligned(sources: list[str], targets: list[str], match: int = 2, mismatch: int = -1, gap: int = -2, half: int = BAND) -> np.ndarray:
    """score, identical, aligned of each pair's best global alignment."""
    found = np.zeros((len(sources), 3), dtype=np.int64)
    left = sorted(range(len(sources)), key=lambda i: (abs(len(sources[i]) - len(targets[i])), len(sources[i])))
    while left:
        again, at = [], 0
        while at < len(left):
            to, width = at, 0
            while to < len(left):
                width = max(width, abs(len(sources[left[to]]) - len(targets[left[to]])) + 2 * half + 1)
                if to > at and (to + 1 - at) * width > CELLS:
                    break
                to += 1
            own = left[at:to]
            best = banded([sources[i] for i in own], [targets[i] for i in own], half, match, mismatch, gap)
            for i, value in zip(own, best.tolist(), strict=True):
                m, n = len(sources[i]), len(targets[i])
                score, mask = value >> (2 * BITS), (1 << BITS) - 1
                # a path outside spends half + 1 steps more than it must in either direction
                outside = match * max(min(m, n) - half - 1, 0) + gap * (2 * (half + 1) + abs(m - n))
                if score > outside or half >= max(m, n):
                    found[i] = score, (value >> BITS) & mask, value & mask
                else:
                    again.append(i)
            at = to
        left, half = again, 2 * half
    return found


def identities(pairs: DataFrame, source: str, target: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> DataFrame:
    """pairs with score, identical, aligned, identity (percent of aligned pairs that are identical) and coverage (percent of
    the source that is aligned), both to four decimals, 0 where nothing is aligned. A null sequence gives nulls. Letters
    are counted up to 2 ** 20 - 1 a sequence."""
    schema = StructType([*pairs.schema.fields, *StructType.fromDDL("score long, identical long, aligned long").fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known = frame[source].notna() & frame[target].notna()
            own = frame[known]
            # equal pairs are aligned once
            keys = list(zip(own[source], own[target], strict=True))
            distinct = list(dict.fromkeys(keys))
            found = dict(zip(distinct, aligned([k[0] for k in distinct], [k[1] for k in distinct], match, mismatch, gap).tolist(), strict=True))
            values = pd.DataFrame([found[k] for k in keys], columns=["score", "identical", "aligned"], index=own.index).reindex(frame.index).astype("Int64")
            yield pd.concat((frame, values), axis=1)

    found = pairs.mapInPandas(run, schema)
    percent = lambda a, b: F.when(F.col("aligned").isNull(), F.lit(None)).when(b == 0, 0.0).otherwise(F.round(100 * a / b, 4))
    return found.withColumns({"identity": percent(F.col("identical"), F.col("aligned")), "coverage": percent(F.col("aligned"), F.length(source))})


def best_alignments(found: DataFrame, by: str, row_id: str) -> DataFrame:
    """Of each value of by the row with the largest coverage plus identity, then score, then the smallest id."""
    order = F.struct(F.round(F.col("coverage") + F.col("identity"), 4).alias("sum"), F.col("score"), (-F.col(row_id)).alias("id"))
    return found.groupBy(by).agg(F.max_by(F.struct(*[c for c in found.columns if c != by]), order).alias("b")).select(by, "b.*")
