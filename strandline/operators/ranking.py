"""Best-of, top-k, dedup and greedy selection over scored hits. Every order ends in a unique key, so ties are settled."""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grouped import Group, cells_of, in_groups, whole_runs


def top_rows(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group. n 1 is one max-like aggregate; more is a rank that Spark limits before it shuffles."""
    window = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("rank_in_group", F.row_number().over(window)).filter(F.col("rank_in_group") <= n)


def best_in_genome(
    hits: DataFrame, by: Sequence[str], min_coverage: float, min_identity: float, near_coverage: float = 1.05, near_identity: float = 0.97,
    place: Sequence[str] = (), order: Sequence[Column] = (), spliced: str | None = None,
) -> DataFrame:
    """Hits of a group with its best coverage that pass both minima, or have near_coverage times the minimal coverage and
    near_identity times the minimal identity.

    With order (columns that rank a group's hits, unique at the end) the first hit is the group's best: with place (the
    columns that name a sequence) hits that begin before it and end after it on the same sequence go, and with spliced (a
    boolean column), if the best is spliced, the unspliced ones go as probable processed pseudogenes."""
    group = Window.partitionBy(*by)
    passes = (F.col("coverage") >= min_coverage) & (F.col("identity") >= min_identity)
    near = (F.col("coverage") >= near_coverage * min_coverage) & (F.col("identity") >= near_identity * min_identity)
    good = (F.col("coverage") == F.max("coverage").over(group)) & (passes | near)
    names = ["start", "end", *place, *([spliced] if spliced else [])]
    if order:
        best = F.first(F.struct(*names)).over(group.orderBy(*order))
        marked = hits.withColumn("_best", best)
        first = F.row_number().over(group.orderBy(*order)) == 1
        if place:
            same = F.lit(True)
            for name in place:
                same = same & (F.col(f"_best.{name}") == F.col(name))
            good = good & ~(same & (F.col("start") < F.col("_best.start")) & (F.col("end") > F.col("_best.end")))
        if spliced:
            good = good & (first | F.col(spliced) | ~F.col(f"_best.{spliced}"))
        return marked.withColumn("_good", good).filter("_good").drop("_best", "_good")
    return hits.withColumn("_good", good).filter("_good").drop("_good")


def best_within(hits: DataFrame, by: Sequence[str], score: str, within: float, least: float) -> DataFrame:
    """Rows within `within` of their group's best score and not under least; none of a group whose best is under least."""
    best = hits.withColumn("_best", F.max(score).over(Window.partitionBy(*by)))
    return best.filter((F.col("_best") >= least) & (F.col(score) >= F.col("_best") - within) & (F.col(score) >= least)).drop("_best")


def capped_by_value(rows: DataFrame, by: Sequence[str], value: str, cap: int, most: float | None = None) -> DataFrame:
    """Of each family the rows up to its cap-th smallest value, ties of that value included; without those over most."""
    rank = F.rank().over(Window.partitionBy(*by).orderBy(value))
    kept = rows.withColumn("rank_in_group", rank).filter(F.col("rank_in_group") <= cap)
    return kept if most is None else kept.filter(F.col(value) <= most)


def deduplicated(rows: DataFrame, key: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    names = [F.col(k) if isinstance(k, str) else k for k in key]
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(*order))).filter("_n = 1").drop("_n")


def best_of_two(first: DataFrame, second: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Full outer join of two sources on key: the row with the larger coverage + identity, ties to the second; key, winner,
    loser (null if only one source has the key), total."""
    a = first.select(key, (F.col("coverage") + F.col("identity")).alias("_a"))
    b = second.select(key, (F.col("coverage") + F.col("identity")).alias("_b"))
    both = a.join(b, key, "full_outer")
    first_wins = F.col("_b").isNull() | (F.col("_a") > F.col("_b"))
    return both.select(
        key,
        F.when(first_wins, names[0]).otherwise(names[1]).alias("winner"),
        F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.when(first_wins, names[1]).otherwise(names[0])).alias("loser"),
        F.when(first_wins, F.col("_a")).otherwise(F.col("_b")).alias("total"),
    )


def non_overlapping(hits: DataFrame, by: Sequence[str], score: str, row_id: str, scope: int | None = None) -> DataFrame:
    """Greedy selection: in each group, by score descending (ties by row_id), a hit is kept if it overlaps none kept.

    The choice is sequential within a set of hits that chain by overlap, but independent between such sets, so groups are
    first cut into islands: what one task holds is one island, however large its group is. Kept hits are disjoint and lie
    in order of start, so each hit is held against two of them."""
    from .intervals import SCAN_BIN, with_island

    islands = with_island(hits, by, scan_bin=scope or SCAN_BIN)
    schema = islands.schema
    names = [*by, "island"]

    def choose(group: Group) -> Iterator[tuple]:
        starts, ends = [], []
        for row in zip(*(group[c] for c in schema.names), strict=True):
            s, e = row[first], row[last]
            at = bisect.bisect_right(starts, s)
            if (at == 0 or ends[at - 1] < s) and (at == len(starts) or starts[at] > e):
                starts.insert(at, s)
                ends.insert(at, e)
                yield row

    first, last = schema.names.index("start"), schema.names.index("end")
    return in_groups(islands, names, [F.desc(score), row_id], choose, schema).drop("island")


def domains(hits: DataFrame, by: Sequence[str], family: str, score: str, row_id: str, scope: int | None = None) -> DataFrame:
    """Two greedy selections: first within each family of a group, then across families among those that stay."""
    return non_overlapping(non_overlapping(hits, [*by, family], score, row_id, scope), by, score, row_id, scope)


def depth_capped(hits: DataFrame, by: Sequence[str], name: str, score: str, cap: int, min_identity: float, scope: int | None = None, protected: Column | None = None) -> DataFrame:
    """Hit names of each group by (best score, best identity) descending, then name: a name stays if one of its bases has
    been covered by fewer than cap hits of the names before it, or if one of its hits is protected. Depth counts names that
    did not stay too, so no state is carried from one verdict to the next: it is a count of earlier hits over each base.

    Groups are cut into islands of overlapping hits first; a name stays if it does in one of its islands."""
    from .intervals import SCAN_BIN, with_island

    good = hits.filter(F.col("identity") >= min_identity)
    safe = F.lit(False) if protected is None else F.coalesce(protected, F.lit(False))
    ranks = good.groupBy(*by, name).agg(F.max(score).alias("_score"), F.max("identity").alias("_identity"), F.max(safe).alias("_safe"))
    ranked = good.join(ranks, [*by, name])
    islands = with_island(ranked, by, scan_bin=scope or SCAN_BIN)
    schema = islands.select(*by, name).schema
    rows = islands.select(*by, "island", name, "start", "end", "_score", "_identity", "_safe")

    def stay(group: Group) -> Iterator[tuple]:
        place, spans, n = tuple(group[b][0] for b in by), *cells_of(group["start"], group["end"])
        covered = np.zeros(n, dtype=np.int64)
        for a, b in whole_runs(group[name]):
            if group["_safe"][a] or any((covered[x:y] < cap).any() for x, y in spans[a:b]):
                yield *place, group[name][a]
            for x, y in spans[a:b]:
                covered[x:y] += 1

    return in_groups(rows, [*by, "island"], [F.desc("_score"), F.desc("_identity"), name], stay, schema).distinct()


def layered(genes: DataFrame, exons: DataFrame, layers: Sequence[tuple[str, Sequence[str], Sequence[str], bool]], keys: Sequence[str], width: int) -> DataFrame:
    """Layer selection. layers: (name, biotypes, names of layers it is filtered against, discard). Genes of a layer stay
    if none of their exons overlaps one of a survivor of the named layers; layers to discard block but are not returned.
    A layer is one anti join against all its blockers together; exons and genes are computed once."""
    from .graph import checkpointed
    from .intervals import anti_overlap

    exons = checkpointed(exons.select("gene_id", *keys, "start", "end"))
    genes = checkpointed(genes)
    out, survivors = [], {}
    for name, biotypes, against, discard in layers:
        own = genes.filter(F.col("biotype").isin(*biotypes))
        known = [survivors[other] for other in against if other in survivors]
        if known:
            ids = known[0]
            for more in known[1:]:
                ids = ids.union(more)
            blockers = exons.join(ids, "gene_id", "left_semi")
            own = anti_overlap(own, exons.join(own.select("gene_id"), "gene_id", "left_semi"), blockers.select(*keys, "start", "end"), keys, ["gene_id"], width)
        own = checkpointed(own.withColumn("layer", F.lit(name)))
        survivors[name] = own.select("gene_id")
        if not discard:
            out.append(own)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
