"""Composite rules of gene building: matching by intron chain, soft matches, bins of frame lengths, pruning, readthroughs,
set cover, runs of hits, paths and hierarchies."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .graph import checkpointed
from .grouped import Group, in_groups


def chain_matches(primary: DataFrame, secondary: DataFrame, key: Sequence[str], row_id: str) -> DataFrame:
    """secondary's row_id with match, the smallest primary id of equal key, or null. The primary side is one row a key
    before the join, so a chain that many genes share makes no pairs."""
    first = primary.groupBy(*key).agg(F.min(row_id).alias("match"))
    return secondary.join(first, list(key), "left").select(row_id, "match")


def soft_matches(acceptors: DataFrame, donors: DataFrame, key: Sequence[str], priority: str) -> DataFrame:
    """gene_id, donor_id, shared: for each acceptor the donor with the best priority (smallest), then most shared introns,
    then smallest id. acceptors and donors are intron rows."""
    a = acceptors.select("gene_id", *key).distinct()
    d = donors.select(F.col("gene_id").alias("donor_id"), priority, *key).distinct()
    shared = a.join(d, list(key)).filter("gene_id <> donor_id").groupBy("gene_id", "donor_id", priority).agg(F.count(F.lit(1)).alias("shared"))
    order = F.struct(F.col(priority), -F.col("shared"), F.col("donor_id"))
    best = shared.groupBy("gene_id").agg(F.min_by(F.struct("donor_id", "shared"), order).alias("b"))
    return best.select("gene_id", "b.donor_id", "b.shared")


#: Least percent of the longest frame for each bin but the last.
BIN_LIMITS = (75.0, 50.0, 25.0)


def frame_bins(rows: DataFrame, by: Sequence[str], length: str) -> DataFrame:
    """rows with bin: distinct lengths of a group are visited from the longest; a length below its bin's share of the
    longest moves on by one bin, and never by more, so a sharp drop lands in the next bin. The visit is a fold over the
    distinct lengths of one group."""
    lengths = rows.groupBy(*by).agg(F.sort_array(F.collect_set(length), asc=False).alias("lengths"))
    limits = F.array(*map(F.lit, BIN_LIMITS))
    longest = F.get("lengths", F.lit(0))
    none = F.struct(F.lit(0).alias("bin"), F.array().cast("array<struct<length:bigint,bin:int>>").alias("out"))

    def visit(done, value):
        below = 100.0 * value / F.col("longest") < F.coalesce(F.get(limits, done["bin"]), F.lit(0.0))
        bin_ = done["bin"] + below.cast("int")
        return F.struct(bin_.alias("bin"), F.concat(done["out"], F.array(F.struct(value.cast("bigint").alias("length"), bin_.alias("bin")))).alias("out"))

    placed = lengths.withColumn("longest", longest).select(*by, F.explode(F.aggregate("lengths", none, visit, lambda d: d["out"])).alias("p"))
    return rows.join(placed.select(*by, F.col("p.length").alias(length), F.col("p.bin").alias("bin")), [*by, length])


def duplicates_removed(models: DataFrame, key: Sequence[str], row_id: str) -> DataFrame:
    """models without those equal in key to one with a smaller id."""
    return models.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(row_id))).filter("_n = 1").drop("_n")


def collinear_runs(hits: DataFrame, by: Sequence[str], gap: int, row_id: str, direction: str | None = None) -> DataFrame:
    """hits with run: along each key by start, a hit opens a run unless it begins within gap after all before it and its
    hit coordinate goes on: upwards, or downwards where the column direction is negative."""
    order = Window.partitionBy(*by).orderBy("start", row_id)
    near = F.col("start") - F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)) - 1
    sign = F.lit(1) if direction is None else F.col(direction)
    on = sign * (F.col("hit_start") - F.lag("hit_start").over(order)) > 0
    opens = F.coalesce((~((near >= 0) & (near <= gap) & on)).cast("int"), F.lit(1))
    return hits.withColumn("_opens", opens).withColumn("run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_opens")


def readthroughs(transcripts: DataFrame, by: Sequence[str], row_id: str) -> DataFrame:
    """Ids of readthroughs. transcripts: row_id, by, start, end and exons (array of start, end).

    In a locus of three or more overlapping transcripts these are visited from the shortest span. One that strictly
    overlaps no earlier cluster opens one with its own span (which does not grow); one that overlaps two or more is a
    candidate. A candidate is a readthrough unless it overlaps every exon of each of the clusters' other transcripts (of
    a single-exon transcript by a twentieth of it). Sequential within an island of overlapping transcripts, which is what
    a task holds."""
    from .intervals import SCAN_BIN, with_island

    pick = lambda c: F.transform("exons", lambda e: e[c].cast("long"))
    islands = with_island(transcripts.select(row_id, *by, "start", "end", pick("start").alias("starts"), pick("end").alias("ends")), by, scan_bin=SCAN_BIN)
    schema = transcripts.select(row_id).schema
    names = [*by, "island"]
    def holds(candidate: list[tuple[int, int]], other: list[tuple[int, int]]) -> bool:
        for s, e in other:
            shared = [(max(s, a), min(e, b)) for a, b in candidate if a <= e and s <= b]
            if not shared or len(other) == 1 and shared[0][1] - shared[0][0] < (e - s + 1) / 20:
                return False
        return True

    def run(group: Group) -> list[tuple]:
        if len(group[row_id]) < 3:  # no two clusters and a bridge
            return []
        clusters: list[tuple[int, int, list]] = []
        candidates = []
        for name, s, e, starts, ends in zip(*(group[c] for c in (row_id, "start", "end", "starts", "ends")), strict=True):
            own = list(zip(starts, ends, strict=True))
            met = [c for c in clusters if c[0] < e and c[1] > s]
            if not met:
                clusters.append((s, e, [own]))
            elif len(met) == 1:
                met[0][2].append(own)
            else:
                candidates.append((name, s, e, own))
        return [(n,) for n, s, e, own in candidates if any(not holds(own, x) for c in clusters if c[0] < e and c[1] > s for x in c[2])]

    return in_groups(islands.withColumn("_size", F.col("end") - F.col("start")), names, ["_size", row_id], run, schema)


def set_cover(rows: DataFrame, by: Sequence[str], candidate: str, value: str, wanted: int) -> DataFrame:
    """by, place, candidate, gained: candidates of each group taken by how many values they add (ties to the smaller
    candidate), until wanted values are covered or nothing is gained."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    distinct = rows.select(*by, candidate, value).distinct()

    def choose(group: Group) -> Iterator[tuple]:
        left: dict = {}
        for c, v in zip(group[candidate], group[value], strict=True):
            left.setdefault(c, set()).add(v)
        # what a candidate adds only shrinks, so the best one is the first whose count, taken anew, is still the largest
        heap, covered, place = [(-len(v), c) for c, v in left.items()], set(), tuple(group[b][0] for b in by)
        heapq.heapify(heap)
        n = 0
        while heap and len(covered) < wanted:
            known, c = heapq.heappop(heap)
            gained = len(left[c] - covered)
            if gained < -known:
                heapq.heappush(heap, (-gained, c))
                continue
            if not gained:
                break
            covered |= left[c]
            n += 1
            yield *place, n, c, gained

    schema = ", ".join([*(f"`{b}` {kinds[b]}" for b in by), "place int", f"`{candidate}` {kinds[candidate]}", "gained long"])
    return in_groups(distinct, by, [candidate, value], choose, schema)


def paths(edges: DataFrame, sources: DataFrame, sinks: DataFrame, by: Sequence[str], longest: int) -> DataFrame:
    """by, path (nodes joined by dots), length: every path from a source to a sink with at most longest edges; by keeps
    graphs apart. Each level is one join, so its cost is the number of partial paths."""
    step = edges.select(*by, F.col("a").alias("at"), F.col("b").alias("next"))
    now = sources.select(*by, F.col("node").alias("at"), F.col("node").cast("string").alias("path"), F.lit(0).alias("length"))
    ends = sinks.select(*by, F.col("node").alias("at"))
    found = now.join(ends, [*by, "at"], "left_semi")
    for _ in range(longest):
        grown = now.join(step, [*by, "at"])
        now = checkpointed(grown.select(*by, F.col("next").alias("at"), F.concat_ws(".", "path", "next").alias("path"), (F.col("length") + 1).alias("length")))
        if now.isEmpty():
            break
        found = found.unionByName(now.join(ends, [*by, "at"], "left_semi"))
    return found.select(*by, "path", "length")


def path_facts(edges: DataFrame, sources: DataFrame, sinks: DataFrame, by: Sequence[str], longest: int) -> DataFrame:
    """by, paths, longest, first_path: how many paths there are from a source to a sink with at most longest edges, the most
    edges of one, and the one whose nodes, joined by dots, sort first. The same as from paths(), but no path is laid out: from
    the sinks backwards each node keeps for each number of edges only how many ways there are and the first of them, so a
    graph costs its edges times longest. A task holds one graph."""
    by = list(by)
    text = lambda c: F.col(c).cast("string")
    rows = edges.select(*by, text("a").alias("a"), text("b").alias("b")).dropna(subset=["a", "b"])
    rows = rows.unionByName(sources.select(*by, F.lit(None).cast("string").alias("a"), text("node").alias("b")).filter("b IS NOT NULL"))
    rows = rows.unionByName(sinks.select(*by, text("node").alias("a"), F.lit(None).cast("string").alias("b")).filter("a IS NOT NULL"))
    rows = rows.dropna(subset=by)

    def run(group: Group) -> Iterator[tuple]:
        into: dict[str, list[str]] = {}
        starts: list[str] = []
        now: dict[str, tuple[int, str]] = {}
        for a, b in zip(group["a"], group["b"], strict=True):
            if a is None:
                starts.append(b)
            elif b is None:
                now[a] = 1, a
            else:
                into.setdefault(b, []).append(a)
        n, most, first, level = 0, 0, None, 0
        while now:
            found = [now[s] for s in starts if s in now]
            if found:
                n, most = n + sum(c for c, _ in found), level
                best = min(p for _, p in found)
                first = best if first is None else min(first, best)
            if level == longest:
                break
            level, before = level + 1, {}
            for b, (c, rest) in now.items():
                for a in into.get(b, ()):
                    way = f"{a}.{rest}"
                    known = before.get(a)
                    before[a] = (c, way) if known is None else (known[0] + c, min(known[1], way))
            now = before
        if n:
            yield *(group[b][0] for b in by), n, most, first

    schema = StructType([*edges.select(*by).schema.fields, *StructType.fromDDL("paths long, longest int, first_path string").fields])
    return in_groups(rows, by, [], run, schema)


def descendants(parents: DataFrame, deepest: int) -> DataFrame:
    """ancestor, node, depth: all nodes below each node of a table (node, parent), by one join a level."""
    level = checkpointed(parents.filter("parent IS NOT NULL").select(F.col("parent").alias("ancestor"), "node", F.lit(1).alias("depth")))
    found = level
    links = parents.select(F.col("node").alias("child"), F.col("parent").alias("node"))
    for _ in range(deepest - 1):
        level = checkpointed(level.join(links, "node").select("ancestor", F.col("child").alias("node"), (F.col("depth") + 1).alias("depth")))
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def extended_ends(acceptors: DataFrame, donors: DataFrame, by: Sequence[str]) -> DataFrame:
    """gene_id, start, end, donor_id: single-block acceptors stretched to the longest donor that strictly contains them
    (smallest donor id at ties); unchanged without one."""
    from .intervals import overlaps

    pairs = overlaps(acceptors.select("gene_id", *by, "start", "end"), donors.select("gene_id", *by, "start", "end"), by)
    holds = pairs.filter("r_gene_id <> gene_id AND r_start < start AND r_end > end")
    best = holds.groupBy("gene_id").agg(F.max_by(F.struct("r_start", "r_end", "r_gene_id"), F.struct(F.col("r_end") - F.col("r_start"), -F.col("r_gene_id"))).alias("d"))
    joined = acceptors.select("gene_id", "start", "end").join(best, "gene_id", "left")
    return joined.select("gene_id", F.coalesce("d.r_start", "start").alias("start"), F.coalesce("d.r_end", "end").alias("end"), F.col("d.r_gene_id").alias("donor_id"))


def id_mapping(old: DataFrame, new: DataFrame, rules: Sequence[Sequence[str]], row_id: str) -> DataFrame:
    """new row_id, old_id, rule: the first rule (list of key columns) by which an old row equals the new one, the smallest
    old id of that key; null where no rule fits."""
    joined = new
    for n, key in enumerate(rules):
        first = old.groupBy(*key).agg(F.min(row_id).alias(f"_old{n}"))
        joined = joined.join(first, list(key), "left")
    old_id = F.coalesce(*[F.col(f"_old{n}") for n in range(len(rules))])
    rule = F.coalesce(*[F.when(F.col(f"_old{n}").isNotNull(), n + 1) for n in range(len(rules))])
    return joined.select(row_id, old_id.alias("old_id"), rule.alias("rule"))
