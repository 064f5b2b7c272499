"""Sequences in chunks, and their parts by region: what a region needs is joined, not whole sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement

#: Bases of one chunk.
CHUNK = 65_536


def chunked(seqs: DataFrame, size: int = CHUNK) -> DataFrame:
    """seq_id, chunk (from 0), seq: sequences (seq_id, seq) in chunks of size bases. Null and empty ones have none."""
    last = F.floor((F.length("seq") - 1) / size).cast("int")
    numbers = seqs.filter(F.length("seq") > 0).select("seq_id", "seq", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    return numbers.select("seq_id", "chunk", F.substr("seq", F.col("chunk") * size + 1, F.lit(size)).alias("seq"))


def fetched(regions: DataFrame, chunks: DataFrame, size: int = CHUNK) -> DataFrame:
    """regions (region_id, seq_id, start, end from 1, strand, ...) with seq: their bases, complemented and reversed on strand
    -1. Bases beyond the sequence's end are left out; null if nothing is left. A region is joined to the chunks that it
    touches, by sequence and chunk, so a long region makes as many rows as it has chunks and no sequence moves whole."""
    first, last = F.floor((F.greatest(F.col("start"), F.lit(1)) - 1) / size).cast("int"), F.floor((F.col("end") - 1) / size).cast("int")
    asked = regions.filter("end >= start AND end >= 1").select("region_id", "seq_id", "start", "end", F.explode(F.sequence(first, last)).alias("chunk"))
    parts = asked.join(chunks.withColumnRenamed("seq", "_part"), ["seq_id", "chunk"])
    base = F.col("chunk").cast("long") * size
    low, high = F.greatest(F.col("start") - base, F.lit(1)), F.least(F.col("end") - base, F.lit(size))
    cut = parts.select("region_id", "chunk", F.substr("_part", low.cast("int"), (high - low + 1).cast("int")).alias("_part"))
    whole = cut.groupBy("region_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "_part"))), lambda p: p["_part"]), "").alias("seq"))
    found = regions.join(whole, "region_id", "left")
    turned = F.when(F.col("strand") == -1, reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    return found.withColumn("seq", F.when(F.length("seq") > 0, turned))
