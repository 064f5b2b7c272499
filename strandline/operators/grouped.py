"""Rules that are sequential within a group: whole groups, one after another, in one pass over sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegralType, StructType

#: Rows of one frame that goes back.
FRAME_ROWS = 10_000

Group = dict[str, list]


def cells_of(starts: list[int], ends: list[int]) -> tuple[list[tuple[int, int]], int]:
    """For each interval the stretches between borders that it covers, as first and past-last number, and how many there
    are: a base-wise state then has one cell for each stretch."""
    borders = sorted({*starts, *(e + 1 for e in ends)})
    place = {x: i for i, x in enumerate(borders)}
    return [(place[s], place[e + 1]) for s, e in zip(starts, ends, strict=True)], len(borders)


def whole_runs(values: list) -> Iterator[tuple[int, int]]:
    """First and past-last places of runs of equal values."""
    at = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[at]:
            yield at, i
            at = i


def open_cells(n: int, coverage: int) -> tuple[Callable[[int, int], bool], Callable[[int, int], None]]:
    """For n cells that nothing covers yet: whether a cell from x up to y is covered fewer than coverage times, and a step
    that covers those cells once more."""
    if 0 <= coverage < 256:
        # a byte a cell, which stays at coverage when it gets there: spans of a few cells are too short for numpy
        held, more = bytearray(n), bytes(min(i + 1, coverage) for i in range(256))

        def cover(x: int, y: int) -> None:
            held[x:y] = held[x:y].translate(more)

        return lambda x, y: held.count(coverage, x, y) < y - x, cover
    covered = np.zeros(n, dtype=np.int64)

    def add(x: int, y: int) -> None:
        covered[x:y] += 1

    return lambda x, y: bool((covered[x:y] < coverage).any()), add


def _plain(column: pd.Series) -> list:
    if column.dtype != object:
        return column.tolist()
    return [x.tolist() if isinstance(x, np.ndarray) else x for x in column.tolist()]


def in_groups(rows: DataFrame, by: Sequence[str], order: Sequence[str], run: Callable[[Group], Iterable[tuple]], schema: str | StructType) -> DataFrame:
    """What run gives for each group of rows with equal values of by, as rows of schema.

    run takes the group's columns as lists, in the given order; arrays of numbers come as lists. Missing values of by are
    equal and come as None. Rows are dealt by the group and sorted within a partition, so many small groups share one call to Python, and a task holds one group."""
    by, names = list(by), rows.columns
    ordered = rows.repartition(*by).sortWithinPartitions(*by, *order)
    places = [names.index(b) for b in by]
    is_whole = [isinstance(f.dataType, IntegralType) for f in rows.schema.fields]
    columns = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Group = {name: [] for name in names}
        out: list[tuple] = []
        for frame in frames:
            lists = [_plain(frame[name]) for name in names]
            for i in places:
                if frame[names[i]].hasnans:
                    # numbers with missing ones come as floats, among which a missing one equals nothing
                    whole = is_whole[i]
                    lists[i] = [None if x is None or x != x else int(x) if whole else x for x in lists[i]]
            changes = np.zeros(max(len(frame) - 1, 0), dtype=bool)
            for i in places:
                values = frame[names[i]].to_numpy()
                plain = values.dtype != object and not frame[names[i]].hasnans
                changes |= values[1:] != values[:-1] if plain else np.array([a != b for a, b in pairwise(lists[i])], dtype=bool)
            for at, to in pairwise([0, *(np.flatnonzero(changes) + 1).tolist(), len(frame)] if len(frame) else []):
                if held[by[0]] and any(held[names[i]][0] != lists[i][at] for i in places):
                    out.extend(run(held))
                    held = {name: [] for name in names}
                for name, values in zip(names, lists, strict=True):
                    held[name].extend(values[at:to])
                if len(out) >= FRAME_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
        if held[by[0]]:
            out.extend(run(held))
        if out:
            yield pd.DataFrame(out, columns=columns)

    return ordered.mapInPandas(apply, schema)
