"""Refining single models and alignments: flags, acceptance, internal stops, tails, keys, support, merged hits, clusters of
supported models, and selection under a depth cap."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .graph import components, written
from .grouped import Group, cells_of, in_groups, open_cells, whole_runs
from .intervals import JOIN_BIN, SCAN_BIN, depth, overlapping, with_island

#: Hits of a strand of a place that a task judges at most as they are.
PLACE_HITS = 100_000


def flagged(models: DataFrame, introns: DataFrame, blessed: Sequence[str], shortest: int = 10) -> DataFrame:
    """gene_id, frameshift, only_frameshift, non_canonical, incomplete, flag of models whose biotype is not blessed.

    introns: gene_id, length, canonical. An intron under shortest is a frameshift, any other that is not canonical counts
    against its model. incomplete follows the order of operators in the rule it repeats: an ATG counts only beside a TAG."""
    facts = introns.groupBy("gene_id").agg(
        F.count_if(F.col("length") < shortest).alias("_short"), F.count(F.lit(1)).alias("_n"), F.count_if((F.col("length") >= shortest) & ~F.col("canonical")).alias("_odd")
    )
    joined = models.filter(~F.col("biotype").isin(*blessed)).join(facts, "gene_id", "left").fillna(0, ["_short", "_n", "_odd"])
    whole = (F.col("first_codon") == "ATG") & (F.col("last_codon") == "TAG") | F.col("last_codon").isin("TAA", "TGA")
    short, odd = F.col("_short") > 0, F.col("_odd") > 0
    return joined.select(
        "gene_id", short.alias("frameshift"), (short & (F.col("_short") == F.col("_n"))).alias("only_frameshift"), odd.alias("non_canonical"),
        (~F.coalesce(whole, F.lit(False))).alias("incomplete"), (short | odd).alias("flag"),
    )


def accepted_alignments(parts: DataFrame, read_id: str, least_identity: float, least_coverage: float, most_mismatch: float) -> DataFrame:
    """read_id, parts, mismatch of the alignments that are spliced, good enough as a whole and not over most_mismatch
    percent of mismatches. parts: read_id, start, end, identity, coverage, mismatches."""
    whole = parts.groupBy(read_id).agg(
        F.count(F.lit(1)).alias("parts"), F.min("identity").alias("_identity"), F.min("coverage").alias("_coverage"),
        F.round(100 * F.sum("mismatches") / F.sum(F.col("end") - F.col("start") + 1), 4).alias("mismatch"),
    )
    good = (F.col("parts") > 1) & (F.col("_identity") >= least_identity) & (F.col("_coverage") >= least_coverage) & (F.col("mismatch") <= most_mismatch)
    return whole.filter(good).select(read_id, "parts", "mismatch")


def internal_stops(peptides: DataFrame, most: int) -> DataFrame:
    """seq_id, stops, fixable: stops before the last residue, and whether introns can take their place: not if the peptide
    is only a stop, if a stop touches an X, or if there are over most."""
    inner = F.regexp_replace("peptide", r"\*$", "")
    stops = F.length(inner) - F.length(F.replace(inner, F.lit("*"), F.lit("")))
    good = (F.col("peptide") != "*") & ~inner.rlike(r"\*X|X\*") & (stops <= most)
    return peptides.select("seq_id", stops.cast("long").alias("stops"), good.alias("fixable"))


def clipped_tail(seq: str | None, buffer: int, window: int = 3, end_region: int = 20) -> str | None:
    """seq without its poly-A tail, again until none is left; null if nothing but tail is.

    A tail is looked for if the last end_region bases have a run of over four A. It begins at the first window (from the
    end, within buffer) that has two A, goes on while windows have two, and is cut behind the base before it if it is
    longer than what stands after it."""
    while seq:
        runs = [len(r) for r in "".join(c if c in "Aa" else " " for c in seq[-end_region:]).split()]
        if max(runs, default=0) <= 4:
            return seq
        length = len(seq)
        has = lambda at: sum(seq[j] == "A" for j in range(max(at - window + 1, 0), at + 1))
        i = next((i for i in range(length - 1, max(length - buffer, -1), -1) if has(i) >= 2), None)
        if i is None:
            return seq
        pos = i
        while pos > window - 1 and has(pos - 1) >= 2:
            pos -= 1
        if pos <= window - 1:
            return None
        if i - pos + window <= length - i:
            return seq
        at = pos - window
        while at <= pos and seq[at] != "A":
            at += 1
        seq = seq[:at]
    return seq


#: Complements, so that a head of T is a tail of A of the other strand.
_TURN = str.maketrans("ACGTacgt", "TGCAtgca")


def clipped_ends(seq: str | None, buffer: int, window: int = 3, end_region: int = 20) -> tuple[str | None, str | None]:
    """seq without its poly-A tail or its poly-T head, and which end was looked at (null: neither).

    The longest run of A in the last end_region bases stands against that of T in the first ones: the longer decides, if it
    is over four. At equal runs over four both ends are tried, and the one that loses more counts; if they lose the same, the
    sequence stays. One no longer than end_region stays. The head is the tail of the other strand."""
    if seq is None or len(seq) <= end_region:
        return seq, None
    run = lambda part, letters: max((len(r) for r in "".join(c if c in letters else " " for c in part).split()), default=0)
    a, t = run(seq[-end_region:], "Aa"), run(seq[:end_region], "Tt")

    def head() -> str | None:
        found = clipped_tail(seq.translate(_TURN)[::-1], buffer, window, end_region)
        return None if found is None else found.translate(_TURN)[::-1]

    if max(a, t) <= 4:
        return seq, None
    if a != t:
        return (clipped_tail(seq, buffer, window, end_region), "tail") if a > t else (head(), "head")
    ends = {"head": head(), "tail": clipped_tail(seq, buffer, window, end_region)}
    sizes = {name: len(s or "") for name, s in ends.items()}
    if sizes["head"] == sizes["tail"]:
        return seq, None
    name = min(sizes, key=sizes.get)
    return ends[name], name


def without_tails(seqs: DataFrame, buffer: int, window: int = 3, end_region: int = 20) -> DataFrame:
    """seqs (seq_id, seq) without poly-A tails and poly-T heads, and the end that was clipped. Null if nothing else is left."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ends = [clipped_ends(s, buffer, window, end_region) for s in frame["seq"]]
            yield frame.assign(seq=[s for s, _ in ends], clipped=[e for _, e in ends])

    schema = StructType([*seqs.select("seq_id", "seq").schema.fields, *StructType.fromDDL("clipped string").fields])
    return seqs.select("seq_id", "seq").mapInPandas(run, schema)


def model_keys(exons: DataFrame, place: Sequence[str]) -> DataFrame:
    """gene_id, exon_key, intron_key: hashes of all exon borders and of the inner ones, with the place. Models with equal
    keys are equal; a single exon has no intron key."""
    own = exons.groupBy("gene_id", *place).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("e"))
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ":")
    where = F.concat_ws(":", *[F.col(c).cast("string") for c in place])
    borders = text("e")
    inner = F.regexp_replace(borders, r"^\d+:|:\d+$", "")
    return own.select("gene_id", F.md5(F.concat_ws("|", where, borders)).alias("exon_key"), F.when(F.size("e") > 1, F.md5(F.concat_ws("|", where, inner))).alias("intron_key"))


def exon_support(exons: DataFrame, evidence: DataFrame, keys: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """gene_id, exons, supported, share: exons of each model that some evidence overlaps."""
    own = exons.select("gene_id", *keys, "start", "end").distinct()
    hit = overlapping(own, evidence, keys, ["gene_id", "start", "end"], width).withColumn("_hit", F.lit(1))
    joined = own.join(hit, ["gene_id", "start", "end"], "left")
    counts = joined.groupBy("gene_id").agg(F.count(F.lit(1)).alias("exons"), F.count("_hit").alias("supported"))
    return counts.withColumn("share", F.round(F.col("supported") / F.col("exons"), 4))


def merged_hits(hits: DataFrame, by: Sequence[str], longest_intron: int, lengths: DataFrame, name: str, direction: str | None = None) -> DataFrame:
    """by, run, start, end, percent: hits of one protein along a sequence, joined while both coordinates go on (the
    protein's downwards where the column direction is negative) and the gap to all before is no longer than an intron; percent is the run's part of the protein, overlaps counted once, to one decimal."""
    order = Window.partitionBy(*by).orderBy("start", "end", "hit_start", "hit_end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    sign = F.lit(1) if direction is None else F.col(direction)
    opens = ~((F.col("start") - reached - 1 <= longest_intron) & (sign * (F.col("hit_start") - F.lag("hit_start").over(order)) > 0))
    runs = hits.withColumn("_opens", F.coalesce(opens.cast("int"), F.lit(1))).withColumn("run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    inside = Window.partitionBy(*by, "run").orderBy("hit_start", "hit_end")
    reach = F.max("hit_end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    own = F.greatest(F.col("hit_end") - F.greatest(F.coalesce(reach + 1, F.col("hit_start")), F.col("hit_start")) + 1, F.lit(0))
    spans = runs.withColumn("_own", own).groupBy(*by, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_own").alias("_bases"))
    return spans.join(lengths, name).select(*by, "run", "start", "end", F.round(100 * F.col("_bases") / F.col("length"), 1).alias("percent"))


def processed_clusters(models: DataFrame, pairs: DataFrame, clusters: DataFrame, least: float) -> DataFrame:
    """gene_id, way: of each cluster the models whose exon pairs are shared by at least `least` models on average
    (supported), or, where none is, the backup with the best coverage plus identity, then length, then the smallest id.

    pairs: gene_id and pair (any value that equal pairs have in common); models: gene_id, coverage, identity, length."""
    shared = pairs.distinct().groupBy("pair").agg(F.count(F.lit(1)).alias("_n"))
    support = pairs.distinct().join(shared, "pair").groupBy("gene_id").agg(F.round(F.avg("_n"), 4).alias("_support"))
    rows = clusters.join(models, "gene_id").join(support, "gene_id", "left").withColumn("_good", F.coalesce(F.col("_support") >= least, F.lit(False)))
    order = F.struct(F.round(F.col("coverage") + F.col("identity"), 4).alias("sum"), F.col("length"), (-F.col("gene_id")).alias("id"))
    backups = rows.groupBy("cluster").agg(F.max("_good").alias("_some"), F.max_by("gene_id", order).alias("gene_id")).filter("NOT _some").select("gene_id", F.lit("backup").alias("way"))
    return rows.filter("_good").select("gene_id", F.lit("supported").alias("way")).unionByName(backups)


def capped_hits(
    hits: DataFrame, by: Sequence[str], name: str, least_score: float, most_p: float, coverage: int, scan_bin: int = SCAN_BIN, most: int = PLACE_HITS
) -> DataFrame:
    """hits (score, p_value, strand) of the names that stay. A hit passes if its score is over least_score and its p-value
    under most_p or missing; names without one go, and so do hits that score more than the best passing one of their name.
    Names are taken by that best score, then by the sum of scores over least_score, then by name, on either strand: one is
    accepted if a passing hit that has a p-value holds a base covered by fewer than coverage hits of accepted names; then
    all its hits on the strand add depth. A name accepted on one strand keeps its hits on both.

    A strand of a place with up to `most` hits is judged whole by one task. Of larger ones only islands of overlapping hits
    that go over the cap are judged in order, and only those that names link are held by one task."""
    by, place = list(by), [*by, "strand"]
    over = F.col("score") > least_score
    fit = over & (F.col("p_value").isNull() | (F.col("p_value") < most_p))
    own = Window.partitionBy(*by, name)
    facts = {"_best": F.max(F.when(fit, F.col("score"))).over(own), "_total": F.round(F.sum(F.when(over, F.col("score"))).over(own), 4)}
    known = reduce(and_, [F.col(c).isNotNull() for c in (*by, name)])
    rows = written(hits.filter(known).withColumns(facts).filter("_best > 0 AND score <= _best").withColumn("_fits", over & F.coalesce(F.col("p_value") < most_p, F.lit(False))))
    judged = rows.filter("strand IS NOT NULL AND start <= end").select(*place, name, "start", "end", "_best", "_total", "_fits")
    # one row for every `most` hits at the most
    crowded = judged.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*place)

    def run(group: Group) -> Iterator[tuple]:
        where, spans, n = tuple(group[b][0] for b in by), *cells_of(group["start"], group["end"])
        (is_open, cover), fits, free = open_cells(n, coverage), group["_fits"], group.get("_free")
        for a, b in whole_runs(group[name]):
            if free and free[a] or any(fits[i] and is_open(*spans[i]) for i in range(a, b)):
                yield *where, group[name][a]
                for i in range(a, b):
                    cover(*spans[i])

    schema, order = rows.select(*by, name).schema, [F.desc("_best"), F.desc("_total"), name]
    if crowded.isEmpty():
        accepted = in_groups(judged, place, order, run, schema)
    else:
        crowded = F.broadcast(crowded)
        free, linked = linked_islands(judged.join(crowded, place, "left_semi"), place, name, coverage, scan_bin)
        accepted = in_groups(judged.join(crowded, place, "left_anti"), place, order, run, schema)
        accepted = accepted.unionByName(in_groups(linked, [*place, "_piece"], order, run, schema)).unionByName(free.select(*by, name))
    return rows.drop("_best", "_total", "_fits").join(accepted, [*by, name], "left_semi")


def linked_islands(hits: DataFrame, place: Sequence[str], name: str, coverage: int, scan_bin: int = SCAN_BIN) -> tuple[DataFrame, DataFrame]:
    """Names (place, name) with a hit that fits in an island of overlapping hits that does not go over the cap, where each
    base stays open; and the hits of islands that do, with _free (its name is one of those) and _piece, the islands that
    names link."""
    place = list(place)
    islands = written(with_island(hits, place, scan_bin=scan_bin))
    full = depth(islands, [*place, "island"], scan_bin).groupBy(*place, "island").agg(F.max("depth").alias("_most")).filter(F.col("_most") > coverage).select(*place, "island", F.lit(True).alias("_full"))
    marked = written(islands.join(full, [*place, "island"], "left"))
    free = marked.filter("_full IS NULL AND _fits").select(*place, name).distinct().withColumn("_free", F.lit(True))
    judged = marked.filter("_full").join(free, [*place, name], "left")
    node = F.struct(*place, "island")
    hubs = judged.groupBy(*place, name).agg(F.min(node).alias("hub"))
    linked = judged.select(*place, name, node.alias("node")).distinct().join(hubs, [*place, name])
    pieces = components(linked.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    ready = judged.withColumn("node", node).join(pieces, "node")
    return free, ready.select(*place, name, "start", "end", "_best", "_total", "_fits", F.coalesce("_free", F.lit(False)).alias("_free"), F.col("root.island").alias("_piece"))


def pruned_depth(hits: DataFrame, by: Sequence[str], row_id: str, coverage: int, scan_bin: int = SCAN_BIN) -> DataFrame:
    """hits without those that must go until no base is covered by more than coverage: again and again the hit with the
    lowest score (then largest id) over the most covered base, the first of equals. Sequential within an island."""
    islands = with_island(hits, by, scan_bin=scan_bin)
    schema = islands.schema

    def run(group: Group) -> Iterator[tuple]:
        rows = list(zip(*(group[c] for c in schema.names), strict=True))
        if len(rows) > coverage:
            spans, n = cells_of(group["start"], group["end"])
            covered = np.zeros(n + 1, dtype=np.int64)
            over: dict[int, list[int]] = {}
            for a, b in spans:
                covered[a] += 1
                covered[b] -= 1
            covered = np.cumsum(covered)
            keep = [True] * len(rows)
            while covered.max() > coverage:
                at = int(covered.argmax())
                if at not in over:  # rows come with the first to go first
                    over[at] = [i for i in range(len(rows) - 1, -1, -1) if spans[i][0] <= at < spans[i][1]]
                while True:
                    gone = over[at].pop()
                    if keep[gone]:
                        break
                keep[gone] = False
                covered[spans[gone][0] : spans[gone][1]] -= 1
            rows = [r for r, stays in zip(rows, keep, strict=True) if stays]
        yield from rows

    return in_groups(islands, [*by, "island"], ["score", F.desc(row_id)], run, schema).drop("island")


def identity_summary(hits: DataFrame, by: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """by, tier, n, least, mean, most: hits by the first bound their identity reaches (tiers from 1; one more for the rest)."""
    tier = F.lit(len(bounds) + 1)
    for i in range(len(bounds) - 1, -1, -1):
        tier = F.when(F.col("identity") >= bounds[i], i + 1).otherwise(tier)
    grouped = hits.withColumn("tier", tier.cast("int")).groupBy(*by, "tier")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min("identity").alias("least"), F.round(F.avg("identity"), 4).alias("mean"), F.max("identity").alias("most"))


def by_evidence_set(models: DataFrame, sets: DataFrame, biotype: Column | str = "biotype") -> DataFrame:
    """models with evidence_set, the set that lists their biotype (the first by name), or null. sets: evidence_set, biotype."""
    first = sets.groupBy(F.col("biotype").alias("_biotype")).agg(F.min("evidence_set").alias("evidence_set"))
    own = F.col(biotype) if isinstance(biotype, str) else biotype
    return models.join(first, own == F.col("_biotype"), "left").drop("_biotype")
