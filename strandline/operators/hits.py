"""Rules on sets of scored hits: best of each cluster, overlap resolution, votes, evidence coverage and probe collapse."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grouped import Group, in_groups
from .intervals import JOIN_BIN, overlaps, with_island
from .ranking import non_overlapping


def best_names_per_cluster(hits: DataFrame, by: Sequence[str], name: str, score: str, n: int, scan_bin: int) -> DataFrame:
    """by, island, name, total, mean: of each cluster of overlapping hits the n names with the largest summed score, then
    mean identity, then name."""
    islands = with_island(hits, by, scan_bin=scan_bin)
    totals = islands.groupBy(*by, "island", name).agg(F.round(F.sum(score), 4).alias("total"), F.round(F.avg("identity"), 4).alias("mean"))
    order = Window.partitionBy(*by, "island").orderBy(F.desc("total"), F.desc("mean"), name)
    return totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def hit_space_selection(hits: DataFrame, name: str, score: str, row_id: str) -> DataFrame:
    """Greedy selection in the coordinates of each hit sequence (hit_start, hit_end) instead of the region's."""
    turned = hits.withColumnsRenamed({"start": "_s", "end": "_e", "hit_start": "start", "hit_end": "end"})
    return non_overlapping(turned, [name], score, row_id).withColumnsRenamed({"start": "hit_start", "end": "hit_end", "_s": "start", "_e": "end"})


def beaten_by_overlap(hits: DataFrame, by: Sequence[str], score: str, row_id: str, width: int = JOIN_BIN) -> DataFrame:
    """hits without those that a hit with a larger score (then smaller id) overlaps. Every hit is held against all, kept
    or not. A hit's rivals are reduced to the best one as they are found, so no list of pairs is gathered."""
    own = hits.select(row_id, *by, "start", "end", score)
    pairs = overlaps(own, own, by, width).filter(f"{row_id} <> r_{row_id}")
    ahead = F.struct(F.col(f"r_{score}").alias("score"), (-F.col(f"r_{row_id}")).alias("order"))
    best = pairs.groupBy(row_id).agg(F.max(ahead).alias("_best"))
    me = F.struct(F.col(score).alias("score"), (-F.col(row_id)).alias("order"))
    return hits.join(best, row_id, "left").filter(F.col("_best").isNull() | (me > F.col("_best"))).drop("_best")


def weighted_vote(rows: DataFrame, group: str, row_id: str, weights: Mapping[str, int]) -> DataFrame:
    """group, row_id, votes: of each group the row with the largest sum of weights of its true flags, smallest id at ties."""
    votes = sum((F.when(F.col(flag), weight).otherwise(0) for flag, weight in weights.items()), F.lit(0))
    best = rows.withColumn("votes", votes).groupBy(group).agg(F.max_by(F.struct(row_id, "votes"), F.struct("votes", -F.col(row_id))).alias("b"))
    return best.select(group, f"b.{row_id}", "b.votes")


def evidence_coverage(hits: DataFrame, by: Sequence[str], lengths: DataFrame, name: str) -> DataFrame:
    """by, name, percent: whole percent of each evidence sequence under the span from its first to its last hit base."""
    spans = hits.groupBy(*by, name).agg((F.max("hit_end") - F.min("hit_start") + 1).alias("span"))
    return spans.join(lengths, name).select(*by, name, F.floor(100 * F.col("span") / F.col("length")).cast("long").alias("percent"))


def collapsed_probes(probes: DataFrame, key: Sequence[str], members: Sequence[str]) -> DataFrame:
    """One row for each key with its members, sorted and distinct, and their number."""
    listed = F.array_sort(F.collect_set(F.concat_ws(":", *members)))
    return probes.groupBy(*key).agg(listed.alias("members")).withColumn("n", F.size("members").cast("long"))


def _consistent(spans: list[tuple[int, int]], gaps: list[tuple[int, int]], cluster: dict) -> bool:
    """Whether a hit's features keep out of the cluster's introns, and the stretches between those out of the hit's."""
    if any(s <= b and a <= e for s, e in spans for a, b in cluster["gaps"]):
        return False
    edges = [cluster["start"], *[x for a, b in cluster["gaps"] for x in (a - 1, b + 1)], cluster["end"]]
    solid = list(zip(edges[::2], edges[1::2], strict=True))
    return not any(s <= b and a <= e for s, e in solid for a, b in gaps)


def intron_clusters(hits: DataFrame, by: Sequence[str], row_id: str, scan_bin: int) -> DataFrame:
    """row_id, cluster, meta: hits in clusters that agree on introns, and clusters in meta clusters; each named by its first
    hit. hits: row_id, by (strand among them), starts, ends (features in order).

    Hits come by start, longest first, then id. One joins the first cluster that spans it and with whose introns it agrees;
    else it opens one, with its own span and introns, which later hits do not change. A cluster joins the first meta
    cluster that overlaps it, which does not grow either. Only what lies in one island of overlapping hits can meet, so that
    is what a task holds, and of it only clusters that still reach the present position are looked at."""
    by = list(by)
    rows = hits.select(row_id, *by, "starts", "ends", F.array_min("starts").alias("start"), F.array_max("ends").alias("end"))
    islands = with_island(rows, by, scan_bin=scan_bin)
    kind = dict(hits.dtypes)[row_id]

    def run(group: Group) -> Iterator[tuple]:
        clusters: list[dict] = []
        metas: list[tuple] = []
        for name, starts, ends, s, e in zip(*(group[c] for c in (row_id, "starts", "ends", "start", "end")), strict=True):
            spans = list(zip(starts, ends, strict=True))
            gaps = [(b + 1, a - 1) for b, a in zip(ends, starts[1:], strict=False)]
            clusters = [c for c in clusters if c["end"] >= s]
            found = next((c for c in clusters if c["end"] >= e and _consistent(spans, gaps, c)), None)
            if found is None:
                metas = [x for x in metas if x[1] >= s]
                meta = next((x for x in metas if x[0] <= e and s <= x[1]), None)
                if meta is None:
                    meta = (s, e, name)
                    metas.append(meta)
                found = {"start": s, "end": e, "gaps": gaps, "name": name, "meta": meta[2]}
                clusters.append(found)
            yield name, found["name"], found["meta"]

    return in_groups(islands, [*by, "island"], ["start", F.desc("end"), row_id], run, f"`{row_id}` {kind}, cluster {kind}, meta {kind}")
