"""Genomic roles of the driver's tables, as DataFrames and as SQL of the same rows.

Exons lie on o_custkey's region in the order of their line items, 60 bases apart; features lie at their ship date, much
denser; reads are events on their user's region; sequences are texts in a four-letter alphabet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Orders of customers in groups of this size share a region.
CUSTOMERS_PER_REGION = 15
RANK_KEY = ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(column: str):
    return F.datediff(F.col(column).cast("date"), F.lit("1995-01-01").cast("date"))


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene_id, rank, region, strand, start, end, biotype, source, hit, score, identity, coverage."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *RANK_KEY, "l_discount", "l_tax", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    ranked = lines.withColumn("rank", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*RANK_KEY)))
    joined = ranked.join(orders, ranked["l_orderkey"] == orders["o_orderkey"])
    start = 20 * _days("o_orderdate") + 60 * (F.col("rank") - 1) + 1
    return joined.select(
        F.col("l_orderkey").alias("gene_id"),
        F.col("rank").cast("int").alias("rank"),
        F.floor(F.col("o_custkey") / CUSTOMERS_PER_REGION).cast("long").alias("region"),
        F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(-1).cast("int").alias("strand"),
        start.cast("long").alias("start"),
        (start + F.col("l_quantity").cast("int") - 1).cast("long").alias("end"),
        F.col("o_orderpriority").alias("biotype"),
        F.col("o_orderstatus").alias("source"),
        F.col("l_partkey").alias("hit"),
        F.col("l_extendedprice").alias("score"),
        F.round(100 * (1 - F.col("l_discount")), 4).alias("identity"),
        F.round(100 * (1 - F.col("l_tax")), 4).alias("coverage"),
    )


EXONS = """
exons AS (
  SELECT l_orderkey AS gene_id, rank::INTEGER AS rank, (o_custkey // 15)::BIGINT AS region,
    CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS strand,
    (20 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 60 * (rank - 1) + 1)::BIGINT AS "start",
    (20 * date_diff('day', DATE '1995-01-01', o_orderdate::DATE) + 60 * (rank - 1) + l_quantity::INTEGER)::BIGINT AS "end",
    o_orderpriority AS biotype, o_orderstatus AS source, l_partkey AS hit, l_extendedprice AS score,
    round(100 * (1 - l_discount), 4) AS identity, round(100 * (1 - l_tax), 4) AS coverage
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS rank
        FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
)"""


def snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene_id, region, strand, source, biotype, rank, start, end, n: exons on a grid of 100 bases at their customer's locus,
    so that the models of a locus share introns; outer ends differ."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *RANK_KEY)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    own = Window.partitionBy("l_orderkey")
    ranked = lines.withColumns({"rank": F.row_number().over(own.orderBy(*RANK_KEY)), "n": F.count(F.lit(1)).over(own)})
    joined = ranked.join(orders, ranked["l_orderkey"] == orders["o_orderkey"])
    at = 1000 * (F.col("o_custkey") % CUSTOMERS_PER_REGION) + 100 * F.col("rank")
    quantity = F.col("l_quantity").cast("int")
    start = at - F.when(F.col("rank") == 1, quantity % 20).otherwise(0) + 21
    end = at + F.when(F.col("rank") == F.col("n"), quantity % 20).otherwise(10 * (quantity > 40).cast("int")) + 60
    return joined.select(
        F.col("l_orderkey").alias("gene_id"),
        F.floor(F.col("o_custkey") / CUSTOMERS_PER_REGION).cast("long").alias("region"),
        F.when(F.floor(F.col("o_custkey") / 2) % 2 == 0, 1).otherwise(-1).cast("int").alias("strand"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_orderpriority").alias("biotype"),
        F.col("rank").cast("int").alias("rank"),
        start.cast("long").alias("start"),
        end.cast("long").alias("end"),
        F.col("n").cast("long").alias("n"),
    )


SNAPPED = """
snapped AS (
  SELECT l_orderkey AS gene_id, (o_custkey // 15)::BIGINT AS region, CASE WHEN (o_custkey // 2) % 2 = 0 THEN 1 ELSE -1 END AS strand, o_orderstatus AS source,
    o_orderpriority AS biotype, rank::INTEGER AS rank,
    (1000 * (o_custkey % 15) + 100 * rank - CASE WHEN rank = 1 THEN l_quantity::INTEGER % 20 ELSE 0 END + 21)::BIGINT AS "start",
    (1000 * (o_custkey % 15) + 100 * rank + CASE WHEN rank = n THEN l_quantity::INTEGER % 20 WHEN l_quantity::INTEGER > 40 THEN 10 ELSE 0 END + 60)::BIGINT AS "end", n
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS rank,
          count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene_id, region, strand, start, end, hit, score, identity, coverage, flag."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    start = _days("l_shipdate") + 1
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("gene_id"),
        F.floor(F.col("o_custkey") / CUSTOMERS_PER_REGION).cast("long").alias("region"),
        F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(-1).cast("int").alias("strand"),
        start.cast("long").alias("start"),
        (start + F.col("l_quantity").cast("int") - 1).cast("long").alias("end"),
        F.col("l_partkey").alias("hit"),
        F.col("l_extendedprice").alias("score"),
        F.round(100 * (1 - F.col("l_discount")), 4).alias("identity"),
        F.round(100 * (1 - F.col("l_tax")), 4).alias("coverage"),
        F.col("l_returnflag").alias("flag"),
    )


FEATURES = """
features AS (
  SELECT l_orderkey AS gene_id, (o_custkey // 15)::BIGINT AS region, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS strand,
    (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) + 1)::BIGINT AS "start",
    (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) + l_quantity::INTEGER)::BIGINT AS "end",
    l_partkey AS hit, l_extendedprice AS score, round(100 * (1 - l_discount), 4) AS identity, round(100 * (1 - l_tax), 4) AS coverage,
    l_returnflag AS flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, region, start, end, biotype, value."""
    start = F.unix_timestamp("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("read_id"),
        F.col("user_id").alias("region"),
        start.alias("start"),
        (start + F.floor(F.col("value") * 1200)).cast("long").alias("end"),
        F.col("event_type").alias("biotype"),
        "value",
    )


READS = """
reads AS (
  SELECT event_id AS read_id, user_id AS region, floor(epoch(ts))::BIGINT AS "start",
    (floor(epoch(ts)) + floor(value * 1200))::BIGINT AS "end", event_type AS biotype, value
  FROM events
)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene_id, region, strand, start, end, biotype, source, exons (array of rank, start, end in order of rank)."""
    keys = ["gene_id", "region", "strand", "biotype", "source"]
    own = F.array_sort(F.collect_list(F.struct("rank", "start", "end")))
    grouped = exons(spark, sf_dir).groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"), own.alias("exons"))
    return grouped.select("gene_id", "region", "strand", "start", "end", "biotype", "source", "exons")


TRANSCRIPTS = """
transcripts AS (
  SELECT gene_id, region, strand, min("start") AS "start", max("end") AS "end", biotype, source, count(*) AS n_exons,
    sum("end" - "start" + 1)::BIGINT AS exon_length
  FROM exons GROUP BY gene_id, region, strand, biotype, source
)"""

#: Letters of a text become bases by their place in the alphabet; anything else is dropped.
LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_id, seq: every document as a sequence of ACGT."""
    kept = F.regexp_replace(F.lower(F.col("text")), "[^a-z]", "")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.translate(kept, LETTERS, BASES).alias("seq"))


SEQUENCES = f"""
sequences AS (
  SELECT doc_id AS seq_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}') AS seq FROM documents
)"""
