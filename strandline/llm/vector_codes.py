"""Vectors as codes: a codebook for each of PARTS parts, fitted by exact integer rounds over flat Hilbert-sorted blocks.

Rows are taken in chunks, one after another as the table stores them, so no row is shuffled: a chunk holds its rows'
labels and, for each part, their pieces of the vector in the order of a Hilbert curve, cut into flat blocks. A block keeps
the box of its pieces (least and largest component), their sums and their number. Chunks are written once and every round
reads them again.

In a round no entry can be nearest to any piece of a block if its least distance to the box exceeds another entry's
largest distance; what is left is the block's shortlist. A shortlist of one entry takes the whole block by its sums, no
piece is read. For others a small kernel compares the pieces with the shortlist alone, in exact integers. Each task adds
up sums and numbers for each part and entry, of which PARTS * ENTRIES rows reach the driver, so what is shared is fixed.

Defined cases: rows whose vector is null or holds a null or non-finite component go; other rows stay, whatever their id,
also if it is null (such a row starts no codebook); of equal ids the vector that sorts first starts a codebook first;
fewer than ENTRIES rows with ids give as many entries as there are,
and none at all one entry of zeros; an empty table gives no rows; vectors of different
lengths are padded with zeros to the longest, and to a multiple of PARTS, very long ones whole; equal pieces fall into one
block or several alike; ties go to the lower entry; codes are exact while squared distances and sums stay under 2 ** 63;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import column, written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Components of one chunk, rows of which are sorted together: 32 MB.
CHUNK = 1 << 22
#: Pieces of one block.
BLOCK = 64
#: Pieces times entries that one step of the kernel compares.
STEP = 1 << 19


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points (n x d, each component under 2 ** bits) on the Hilbert curve, in d * bits bits (64 at most)."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level, from the highest bit
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            place = (place << np.uint64(1)) | ((x[i] >> b) & 1).astype(np.uint64)
    return place


def curve_order(pieces: np.ndarray) -> np.ndarray:
    """Order of pieces along the curve. Of very long ones the first 32 components count, which bears on speed alone."""
    d = min(pieces.shape[1], 32)
    bits = max(1, min(16, 64 // d))
    low = pieces[:, :d].min(axis=0)
    span = np.maximum(pieces[:, :d].max(axis=0) - low, 1).astype(np.float64)
    cells = ((pieces[:, :d] - low) / span * (2**bits - 1)).astype(np.int64)
    return np.argsort(hilbert(cells, bits), kind="stable")


def boxed(pieces: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """First rows, least and largest components, sums and numbers of blocks of consecutive pieces."""
    first = np.arange(0, len(pieces), block)
    return first, np.minimum.reduceat(pieces, first), np.maximum.reduceat(pieces, first), np.add.reduceat(pieces, first), np.diff([*first, len(pieces)])


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries: whether an entry can be nearest to some point of the box, ties included."""
    below, above = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
    return nearest <= farthest.min(axis=1)[:, None]


def assigned(pieces: np.ndarray, first: np.ndarray, size: np.ndarray, lists: np.ndarray, entries: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, nearest entries (ties to the lower) and squared distances of the pieces of blocks, those with shortlists of
    like length together."""
    length = lists[blocks].sum(axis=1)
    blocks, length = blocks[np.argsort(length, kind="stable")], np.sort(length)
    most, at = int(size.max(initial=1)), 0
    while at < len(blocks):
        to = at + 1
        while to < len(blocks) and length[to] == length[at] and (to - at + 1) * most * length[at] <= STEP:
            to += 1
        own = blocks[at:to]
        choice = np.nonzero(lists[own])[1].reshape(len(own), -1)
        rows = np.minimum(first[own][:, None] + np.arange(most), (first + size - 1)[own][:, None])
        far = np.zeros((len(own), most, choice.shape[1]), dtype=np.int64)
        for c in range(pieces.shape[1]):
            far += (pieces[rows, c][:, :, None] - entries[choice, c][:, None, :]) ** 2
        best = far.argmin(axis=2)
        real = np.arange(most)[None, :] < size[own][:, None]
        yield rows[real], np.take_along_axis(choice, best, axis=1)[real], np.take_along_axis(far, best[:, :, None], axis=2)[:, :, 0][real]
        at = to


def chunks_of(fine: DataFrame, width: int, parts: int, chunk: int) -> DataFrame:
    """Chunks of fine (vec_id, label, v): vec_id, label (lists), order and pieces (bytes, part after part)."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table["v"].combine_chunks()
        sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        whole = np.zeros((len(table), width), dtype=np.int64)
        whole[np.repeat(np.arange(len(table)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        orders, pieces = [], []
        for part in np.split(whole, parts, axis=1):
            order = curve_order(part)
            orders.append(order.astype("<i4").tobytes())
            pieces.append(part[order])
        stacked = np.stack(pieces)
        narrow = next(t for t in ("<i2", "<i4", "<i8") if stacked.min() >= np.iinfo(t).min and stacked.max() <= np.iinfo(t).max)
        columns = [pa.array([table[c].to_pylist()], pa.list_(pa.int64())) for c in ("vec_id", "label")]
        columns += [pa.array([b"".join(orders)], pa.binary()), pa.array([narrow]), pa.array([stacked.astype(narrow).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "order", "kind", "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, held, n = max(1, chunk // width), [], 0
        for batch in batches:
            for at in range(0, len(batch), limit):
                part = batch.slice(at, limit)
                if held and n + len(part) > limit:
                    yield packed(held)
                    held, n = [], 0
                held, n = [*held, part], n + len(part)
        if held:
            yield packed(held)

    return fine.mapInArrow(run, "vec_id array<long>, label array<long>, order binary, kind string, pieces binary")


def _unpacked(batch: pa.RecordBatch, at: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Orders (part x row) and pieces (part x row x component) of a chunk."""
    order = np.frombuffer(column(batch, "order")[at].as_buffer(), dtype="<i4").reshape(parts, -1)
    pieces = np.frombuffer(column(batch, "pieces")[at].as_buffer(), dtype=column(batch, "kind")[at].as_py())
    return order, pieces.reshape(parts, order.shape[1], -1).astype(np.int64)


def round_sums(chunks: DataFrame, books: np.ndarray, block: int = BLOCK) -> DataFrame:
    """part, entry, place, n, total: numbers and component sums of the pieces nearest to each entry."""
    parts, count, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, count), dtype=np.int64), np.zeros((parts, count, d), dtype=np.int64)
        for batch in batches:
            for at in range(len(batch)):
                for p, pieces in enumerate(_unpacked(batch, at, parts)[1]):
                    first, low, high, sums, size = boxed(pieces, block)
                    lists = shortlists(low, high, books[p])
                    single = lists.sum(axis=1) == 1
                    sole = lists[single].argmax(axis=1)
                    np.add.at(n[p], sole, size[single])
                    np.add.at(total[p], sole, sums[single])
                    for rows, entry, _ in assigned(pieces, first, size, lists, books[p], np.flatnonzero(~single)):
                        n[p] += np.bincount(entry, minlength=count)
                        by_entry = np.argsort(entry, kind="stable")
                        cut = np.flatnonzero(np.diff(entry[by_entry], prepend=-1))
                        total[p][entry[by_entry[cut]]] += np.add.reduceat(pieces[rows[by_entry]], cut)
        part, entry = np.nonzero(n)
        columns = [np.repeat(part, d), np.repeat(entry, d), np.tile(np.arange(d), len(part)), np.repeat(n[part, entry], d), total[part, entry].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "n", "total"])

    found = chunks.mapInArrow(run, "part long, entry long, place long, n long, total long")
    return found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def fitted(fine: DataFrame, chunks: DataFrame, width: int, parts: int, entries: int, rounds: int, block: int) -> np.ndarray:
    """part x entry x component: codebooks after some rounds. parts * entries * components rows at most reach the driver."""
    first = fine.filter("vec_id IS NOT NULL").select("vec_id", "v").orderBy("vec_id", "v").limit(entries).collect()
    start = np.zeros((len(first), width), dtype=np.int64)
    for i, row in enumerate(first):
        start[i, : len(row["v"])] = row["v"]
    books = start.reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        sums = round_sums(chunks, books, block).toPandas()
        books[sums["part"], sums["entry"], sums["place"]] = sums["total"].to_numpy() // sums["n"].to_numpy()
    return books


def coded(chunks: DataFrame, books: np.ndarray, block: int = BLOCK) -> DataFrame:
    """vec_id, label, codes (array), error of every row of chunks."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                order, pieces = _unpacked(batch, at, parts)
                codes, error = np.zeros((order.shape[1], parts), dtype=np.int32), np.zeros(order.shape[1], dtype=np.int64)
                for p in range(parts):
                    first, low, high, _, size = boxed(pieces[p], block)
                    lists = shortlists(low, high, books[p])
                    for rows, entry, far in assigned(pieces[p], first, size, lists, books[p], np.arange(len(first))):
                        codes[order[p][rows], p] = entry
                        error[order[p][rows]] += far  # a part's rows are distinct
                ids, labels = (column(batch, c)[at].values for c in ("vec_id", "label"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts), pa.int32()), pa.array(codes.reshape(-1)))
                yield pa.RecordBatch.from_arrays([ids, labels, lists, pa.array(error)], names=["vec_id", "label", "codes", "error"])

    return chunks.mapInArrow(run, "vec_id long, label long, codes array<int>, error long")


def compressed(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    chunk: int = CHUNK, block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """Rows vec_id, label, codes, error, and the codebooks (part x entry x component)."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("embedding"))
    fine = named.filter(x.isNotNull() & good).select("vec_id", "label", ints.alias("v"))
    longest = fine.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    chunks = written(chunks_of(fine, width, parts, chunk))
    books = fitted(fine, chunks, width, parts, entries, rounds, block)
    if not books.shape[1]:  # rows without ids only
        books = np.zeros((parts, 1, width // parts), dtype=np.int64)
    return coded(chunks, books, block), books


def op11_hilbert_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of every vector, their errors, the errors' sums over equal labels, and a digest of the codebooks."""
    found, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = written(found)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    sums = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    joined = found.alias("a").join(sums.alias("b"), F.col("a.label").eqNullSafe(F.col("b.label")))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _codebook_round(before: str, after: str) -> str:
    """SQL of one round: nearest entries of every part, then floors of their means; unused entries stay."""
    return f"""{after} AS MATERIALIZED (
  WITH nearest AS (
    SELECT p.part, p.x, arg_min(b.entry, (list_sum(list_transform(list_zip(p.x, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.entry)) AS entry
    FROM parts p JOIN {before} b USING (part) GROUP BY p.n, p.part, p.x
  ), sums AS (
    SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY place) AS e
    FROM (SELECT part, entry, place, sum(x[place])::DOUBLE AS total, count(*) AS n FROM nearest, generate_series(1, len(x)) AS g(place) GROUP BY part, entry, place)
    GROUP BY part, entry
  )
  SELECT b.part, b.entry, coalesce(s.e, b.e) AS e FROM {before} b LEFT JOIN sums s USING (part, entry)
)"""


OP11_SQL = f"""
WITH fine AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT n, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x FROM fine, generate_series(0, 15) AS g(part)
), ranked AS (
  SELECT n, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM fine WHERE vec_id IS NOT NULL QUALIFY entry < 64
), book0 AS MATERIALIZED (SELECT part, entry, x AS e FROM parts JOIN ranked USING (n)),
{_codebook_round("book0", "book1")},
{_codebook_round("book1", "book2")},
last AS MATERIALIZED (
  SELECT n, part, best // 64 AS far, best % 64 AS entry FROM (
    SELECT p.n, p.part, min(list_sum(list_transform(list_zip(p.x, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.entry) AS best
    FROM parts p JOIN book2 b USING (part) GROUP BY p.n, p.part)
), digest AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT n, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM last GROUP BY n
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM fine JOIN coded USING (n), digest
"""
