"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Row numbers follow a fixed order of the rows' contents, so neither file layout nor a retried task changes them. The
permutation of [0, n) can be computed for one row number alone, and so can a row's shard and slot.

Defined cases: a null id or text is a value like others (size 16, checksum of no bytes); a very long text counts by its
size, checksum and hash; repeated rows get row numbers of their own, one after another; an empty table gives no rows;
other columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets in which row numbers are counted: rows of a bucket grow with the table, the table of offsets does not.
BUCKETS = 4096
#: Copies of one row that one task tells apart.
BLOCK = 100_000
#: One key for each round of the network.
ROUND_KEYS = (11, 23, 37, 51)
#: Most walks. Of the a * b < n + a numbers n are inside, so each walk ends with odds of 1 - 1 / sqrt(n) or more, and a
#: walk outside visits each of the fewer than a outer numbers once: up to n = 4096 no walk is longer than this.
WALKS = 64


def _network(x: Column, a: Column, b: Column, seed: int) -> Column:
    """x = left * b + right with left < a, right < b; round by round one half gains a hash of the other, modulo its range."""
    left, right = F.call_function("div", x, b), F.pmod(x, b)
    for i, key in enumerate(ROUND_KEYS):
        if i % 2:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed * 1000 + key)), b), b)
        else:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed * 1000 + key)), a), a)
    return left * b + right


def permuted(rows: DataFrame, seed: int = 0) -> DataFrame:
    """rows with position, the place of row_number under a permutation of [0, n_rows)."""
    n, a, b, once, walked = map(F.col, ("n_rows", "_a", "_b", "_once", "_walked"))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once, lambda at, _: F.when(at < n, at).otherwise(_network(at, a, b, seed)))
    return (
        rows.withColumn("_a", F.ceil(F.sqrt(n.cast("double"))).cast("long"))
        .withColumn("_b", F.call_function("div", n + a - 1, a))
        .withColumn("_once", _network(F.col("row_number"), a, b, seed))
        .withColumn("_walked", F.when(once < n, once).otherwise(walk))
        .withColumn("position", F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long")))
        .drop("_a", "_b", "_once", "_walked")
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with row_number, 0 to n - 1 without gaps, and n_rows. Equal rows count as one until they are numbered, so
    that copies of one row meet in no task; buckets by hash make the numbering parallel."""
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS))
    counted = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("copies")).withColumn("bucket", bucket)
    sizes = counted.groupBy("bucket").agg(F.sum("copies").alias("in_bucket"))
    # one row for each bucket: BUCKETS at most, whatever the table's size
    through = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "bucket", F.coalesce(F.sum("in_bucket").over(through), F.lit(0)).alias("offset"), F.sum("in_bucket").over(everything).alias("n_rows")
    )
    before = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0))).join(F.broadcast(offsets), "bucket")
    # copies of one row are told apart a block at a time, and blocks are spread over tasks
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("copies") - 1, F.lit(BLOCK)))).alias("block")
    dealt = placed.select(*order, "n_rows", (F.col("offset") + F.col("before")).alias("at"), "copies", blocks).repartition("at", "block")
    last = F.least(F.col("copies"), (F.col("block") + 1) * BLOCK) - 1
    nth = F.explode(F.sequence(F.col("block") * BLOCK, last)).alias("nth")
    return dealt.select(*order, "n_rows", "at", nth).select(*order, "n_rows", (F.col("at") + F.col("nth")).alias("row_number"))


def sharded(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row_number, position, shard and slot of each row. Shards differ by one row at most, and
    slots of a shard run from 0 without gaps: position p of the permutation goes to shard p mod shards, slot p div shards."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    placed = permuted(numbered(rows, ["doc_id", "size", "text_crc32", "text_hash"]), seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        "position",
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("position"), F.lit(shards)).cast("long").alias("slot"),
    )


SHARDS = 40


def op3_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 39 by the law `rows`."""
    placed = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )
