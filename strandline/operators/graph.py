"""Connected components, bounded path enumeration and hierarchies over edge tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Nodes that a task holds at most when it settles the edges it meets.
FOREST_NODES = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a local one is set only if it names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, of which each later step reads only the columns that it needs."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges with their lineage cut, and their number and checksums from the same job."""
    seen = Observation()
    out = checkpointed(edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a")).alias("y")))
    return out, (seen.get["n"], seen.get["x"], seen.get["y"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the component's smallest node) for all nodes of edges (a, b); a = b makes a single node.

    Stars contract: each round every node hands its larger, then its smaller neighbours to the smallest one it knows,
    which settles in a number of rounds that grows with the logarithm of the longest chain."""
    edges = checkpointed(edges.select("a", "b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    now, mark = _marked(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after, new = _marked(moved.union(small.select("a", F.col("m").alias("b"))))
        settled = new == mark
        now, mark = after, new
        if settled:
            return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    raise RuntimeError("components did not settle")


def forests(edges: DataFrame, most: int = FOREST_NODES) -> DataFrame:
    """node, root: edges (a, b; neither missing) as stars around the smallest node, as far as a task sees them. A task goes
    through its edges in the order in which they come and lets go of what it holds at most nodes, so a node may come with
    several roots; settled() joins those."""

    def stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root: dict = {}

        def find(x):
            while (up := root[x]) != x:
                root[x] = x = root[up]
            return x

        for frame in frames:
            for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
                if a not in root:
                    root[a] = a
                if a != b:
                    if b not in root:
                        root[b] = b
                    x, y = find(a), find(b)
                    if x < y:
                        root[y] = x
                    elif y < x:
                        root[x] = y
            if len(root) >= most:
                yield pd.DataFrame({"node": list(root), "root": [find(x) for x in root]})
                root = {}
        if root:
            yield pd.DataFrame({"node": list(root), "root": [find(x) for x in root]})

    kind = dict(edges.dtypes)["a"]
    return edges.mapInPandas(stars, f"node {kind}, root {kind}")


def settled(stars: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of stars (node, root, its star's smallest node): stars that share a node
    are one. Only roots that nodes have in common go through the rounds of components()."""
    stars = checkpointed(stars)
    nodes = checkpointed(stars.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")))
    links = stars.join(nodes.filter("low <> high").select("node", "low"), "node").filter("root <> low").select(F.col("root").alias("a"), F.col("low").alias("b"))
    joined = components(links).select(F.col("node").alias("low"), "root")
    return nodes.join(joined, "low", "left").select("node", F.coalesce("root", "low").alias("root"))
