"""Curating sets of gene models: redundancy by coding exons, best backups, non-coding rules, deletion with its consequences,
retrotransposed and split genes, choice and transfer of evidence, lineage, labels and recovery.

Models are rows (gene_id, ...); exons rows (gene_id, start, end, ...). Every order ends in a unique key."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grouped import Group, in_groups
from .intervals import JOIN_BIN, anti_overlap, with_island

#: Bases of a bin in which exon pairs are looked up.
PAIR_BIN = 512


def without_redundant_coding(models: DataFrame, by: Sequence[str], key: str, has_utr: str, blessed: Sequence[str]) -> DataFrame:
    """models without those that have no UTR and whose coding exons (key) equal those of a model with UTR in the same
    group. A kept model takes the blessed biotype of one that it replaces (the smallest by name) unless its own is
    blessed. A null key stands for a model without translation, which is left alone."""
    plain = models.filter(~F.col(has_utr) & F.col(key).isNotNull())
    given = plain.filter(F.col("biotype").isin(*blessed)).groupBy(*by, key).agg(F.min("biotype").alias("_given"))
    kept = models.filter(F.col(has_utr) | F.col(key).isNull())
    full = kept.filter(F.col(key).isNotNull()).select(*by, key).distinct()
    alone = plain.join(full, [*by, key], "left_anti")
    named = kept.join(given, [*by, key], "left")
    takes = F.col("_given").isNotNull() & ~F.col("biotype").isin(*blessed)
    return named.withColumn("biotype", F.when(takes, F.col("_given")).otherwise(F.col("biotype"))).drop("_given").unionByName(alone)


def best_backups(models: DataFrame, by: Sequence[str], row_id: str, least_support: float = 10, most_weight: float = 10) -> DataFrame:
    """by, row_id: the backup model of each group. Models with least_support are visited by row_id; one is a candidate if
    its weight is no larger than most_weight and all weights before it. Of the candidates the best coverage plus identity
    wins, then the longest translation, then the first."""
    fit = models.filter((F.col("support") >= least_support) & (F.col("weight") <= most_weight))
    before = F.min("weight").over(Window.partitionBy(*by).orderBy(row_id).rowsBetween(Window.unboundedPreceding, -1))
    candidates = fit.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("weight") <= F.col("_before")))
    order = F.struct((F.col("coverage") + F.col("identity")).alias("sum"), F.col("length"), (-F.col(row_id)).alias("id"))
    return candidates.groupBy(*by).agg(F.max_by(row_id, order).alias(row_id))


def noncoding_genes(models: DataFrame, exons: DataFrame, coding: DataFrame, keys: Sequence[str], group: str, shortest: int, least_exons: int, shortest_of_few: int, width: int = JOIN_BIN) -> DataFrame:
    """group: genes of models (gene_id, group, length, n_exons) of which no exon overlaps one of coding, and of which one
    model is good: no shorter than shortest, and with least_exons exons or shortest_of_few bases."""
    good = (F.col("length") >= shortest) & ((F.col("n_exons") >= least_exons) | (F.col("length") >= shortest_of_few))
    genes = models.filter(good).select(group).distinct()
    own = exons.join(models.select("gene_id", group), "gene_id")
    return anti_overlap(genes, own.select(group, *keys, "start", "end"), coding.select(*keys, "start", "end"), keys, [group], width)


def long_or_short(models: DataFrame, gene: str, residues: str, length: str, most: float) -> DataFrame:
    """gene, ratio, kind: percent of its length that a gene's best translation takes, to one decimal; long over most."""
    ratio = F.round(F.lit(3.0) * F.col(residues) * 100 / F.col(length), 1)
    return models.groupBy(gene).agg(F.max(ratio).alias("ratio")).withColumn("kind", F.when(F.col("ratio") > most, "long").otherwise("short"))


def after_deletion(models: DataFrame, exons: DataFrame, deleted: DataFrame, gene: str) -> DataFrame:
    """gene, start, end, models: bounds of the genes again after deletion of models (gene_id). Genes that lose all models
    go, and so do exons whose model is gone."""
    left = models.join(deleted.select("gene_id"), "gene_id", "left_anti")
    bounds = exons.join(left.select("gene_id", gene), "gene_id").groupBy(gene).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return bounds.join(left.groupBy(gene).agg(F.count(F.lit(1)).alias("models")), gene)


def spliced_elsewhere(models: DataFrame, hits: DataFrame, n_exons: str, place: str, least_identity: float | None = None, most_p: float | None = None) -> DataFrame:
    """gene_id, evidence: single-exon models with evidence (gene_id, hit) that a multi-exon model at another place has
    too, and how many such pieces: retrotransposed copies. All evidence counts; with bounds, on either side what has an
    identity of at least the least and a p-value under the most. A piece's multi-exon places are reduced to two before the join."""
    if least_identity is not None:
        hits = hits.filter(F.col("identity") >= least_identity)
    if most_p is not None:
        hits = hits.filter(F.col("p_value") < most_p)
    many = hits.join(models.filter(F.col(n_exons) > 1).select("gene_id", place), "gene_id")
    places = many.groupBy("hit").agg(F.min(place).alias("_low"), F.max(place).alias("_high"))
    single = hits.join(models.filter(F.col(n_exons) == 1).select("gene_id", place), "gene_id").select("gene_id", place, "hit").distinct()
    found = single.join(places, "hit").filter((F.col("_low") != F.col(place)) | (F.col("_high") != F.col(place)))
    return found.groupBy("gene_id").agg(F.count(F.lit(1)).alias("evidence"))


def split_genes(parts: DataFrame, by: Sequence[str], row_id: str) -> DataFrame:
    """a, b: neighbouring models of a group (region, strand, piece of evidence) that lie apart and whose parts of the
    evidence (hit_start, hit_end) follow one another without overlap: one gene that was split in two."""
    order = Window.partitionBy(*by).orderBy("start", "end", row_id)
    names = ["start", "hit_start", row_id]
    after = F.lead(F.struct(*names)).over(order)
    pairs = parts.withColumn("_after", after).filter("_after IS NOT NULL")
    apart = (F.col("_after.start") > F.col("end")) & (F.col("_after.hit_start") > F.col("hit_end"))
    return pairs.filter(apart).select(*by, F.col(row_id).alias("a"), F.col(f"_after.{row_id}").alias("b"))


def chosen_by_precedence(models: DataFrame, evidence: str, precedence: Sequence[str], shape: str, row_id: str) -> DataFrame:
    """Of each piece of evidence the model with the largest identity plus coverage; of equals the source that comes first
    in precedence (others last), then the model whose shape sorts first, then the smallest id."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, precedence)), F.col("source")), F.lit(0))
    rank = F.when(place == 0, len(precedence) + 1).otherwise(place)
    order = Window.partitionBy(evidence).orderBy(F.desc(F.round(F.col("identity") + F.col("coverage"), 4)), rank, shape, row_id)
    return models.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def transferred_evidence(models: DataFrame, evidence: DataFrame, key: Sequence[str]) -> DataFrame:
    """gene_id, hit, own: evidence of the models that stay when of those equal in key only the smallest id does. What the
    others had moves over, once each; own tells what the model had before."""
    kept = models.withColumn("_kept", F.min("gene_id").over(Window.partitionBy(*key))).select("gene_id", "_kept")
    moved = evidence.join(kept, "gene_id").groupBy(F.col("_kept").alias("gene_id"), "hit")
    return moved.agg(F.max((F.col("gene_id") == F.col("_kept"))).alias("own"))


def lineage(evidence: DataFrame, features: DataFrame, genes: DataFrame) -> DataFrame:
    """evidence, features, models, genes: how many of each level stand above a piece of evidence. evidence: evidence,
    feature; features: feature, gene_id; genes: gene_id, gene. Evidence without a feature counts 0."""
    whole = evidence.join(features, "feature", "left").join(genes, "gene_id", "left")
    return whole.groupBy("evidence").agg(F.count_distinct("feature").alias("features"), F.count_distinct("gene_id").alias("models"), F.count_distinct("gene").alias("genes"))


def recovered(tissue: DataFrame, tissue_exons: DataFrame, merged: DataFrame, merged_exons: DataFrame, chain: str, keys: Sequence[str], width: int = JOIN_BIN) -> DataFrame:
    """gene_id, way of tissue models that the merged set lacks: no model of it has their intron chain; way tells whether
    any of its exons overlaps them (variant) or not (missed)."""
    new = tissue.join(merged.select(*keys, chain).distinct(), [*keys, chain], "left_anti").select("gene_id")
    missed = anti_overlap(new, tissue_exons.join(new, "gene_id", "left_semi").select("gene_id", *keys, "start", "end"), merged_exons.select(*keys, "start", "end"), keys, ["gene_id"], width)
    return new.join(missed.withColumn("_missed", F.lit(True)), "gene_id", "left").select("gene_id", F.when(F.col("_missed"), "missed").otherwise("variant").alias("way"))


def labelled_models(models: DataFrame, gene: str, order: Sequence[Column], basic: Column) -> DataFrame:
    """models with label: canonical for the first of each gene in order, basic for others that meet the rule, or if no
    model of the gene does, alternative otherwise."""
    place = F.row_number().over(Window.partitionBy(gene).orderBy(*order))
    some = F.max(F.coalesce(basic, F.lit(False))).over(Window.partitionBy(gene))
    label = F.when(place == 1, "canonical").when(F.coalesce(basic, F.lit(False)) | ~some, "basic").otherwise("alternative")
    return models.withColumn("label", label)


def renamed_by_filter(models: DataFrame, passes: Column, suffix: str) -> DataFrame:
    """models; the biotype of those that pass gets a suffix."""
    return models.withColumn("biotype", F.when(F.coalesce(passes, F.lit(False)), F.concat("biotype", F.lit(suffix))).otherwise(F.col("biotype")))


def utr_scores(models: DataFrame, five: str, three: str, tags: str) -> DataFrame:
    """models with utr_score: one for each side that has a UTR, each side's length in hundreds of bases up to five, and two
    for each supporting tag."""
    side = lambda c: F.when(F.col(c) > 0, 1 + F.least(F.floor(F.col(c) / 100), F.lit(5))).otherwise(0)
    return models.withColumn("utr_score", (side(five) + side(three) + 2 * F.coalesce(F.col(tags), F.lit(0))).cast("long"))


def trimmed_utr(exons: DataFrame, low: str, high: str, most: int) -> DataFrame:
    """exons without those beyond the most nearest UTR exons on either side of the coding span low to high. An exon that
    holds coding bases always stays."""
    before, after = F.col("end") < F.col(low), F.col("start") > F.col(high)
    left = F.row_number().over(Window.partitionBy("gene_id", before).orderBy(F.desc("start"), F.desc("end")))
    right = F.row_number().over(Window.partitionBy("gene_id", after).orderBy("start", "end"))
    kept = (~before | (F.col("_left") <= most)) & (~after | (F.col("_right") <= most))
    return exons.withColumns({"_left": left, "_right": right}).filter(kept).drop("_left", "_right")


def cluster_sources(clusters: DataFrame, models: DataFrame, source: str) -> DataFrame:
    """cluster, source, ids: the models of each cluster by the source they come from, in order."""
    joined = clusters.join(models.select("gene_id", source), "gene_id")
    return joined.groupBy("cluster", source).agg(F.array_sort(F.collect_set("gene_id")).alias("ids"))


def cluster_extents(clusters: DataFrame, models: DataFrame) -> DataFrame:
    """cluster, union and common range of its models (null if they share no base), strands (two if they disagree)."""
    joined = clusters.join(models.select("gene_id", "strand", "start", "end"), "gene_id")
    low, high = F.max("start"), F.min("end")
    return joined.groupBy("cluster").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.when(low <= high, low).alias("common_start"), F.when(low <= high, high).alias("common_end"), F.count_distinct("strand").alias("strands"),
    )


def restricted(blocks: DataFrame, low: Column, high: Column) -> DataFrame:
    """Alignment blocks (start, end, target_start, orientation) cut to low..high; those outside go. The target moves with
    the cut end: from its own start on a forward block, from its far end on a reversed one."""
    s, e = F.greatest("start", low), F.least("end", high)
    shift = F.when(F.col("orientation") == 1, s - F.col("start")).otherwise(F.col("end") - e)
    cut = blocks.withColumns({"_s": s, "_e": e, "_shift": shift}).filter("_s <= _e")
    return cut.withColumns({"start": F.col("_s"), "end": F.col("_e"), "target_start": F.col("target_start") + F.col("_shift")}).drop("_s", "_e", "_shift")


def to_slice(features: DataFrame, slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """features in coordinates of the slices (keys, slice_start, slice_end, slice_strand) that hold them whole; on a reversed
    slice positions count from its end and strands turn."""
    held = features.join(slices, list(keys)).filter("start >= slice_start AND end <= slice_end")
    ahead = F.col("slice_strand") == 1
    return held.withColumns(
        {
            "start": F.when(ahead, F.col("start") - F.col("slice_start") + 1).otherwise(F.col("slice_end") - F.col("end") + 1),
            "end": F.when(ahead, F.col("end") - F.col("slice_start") + 1).otherwise(F.col("slice_end") - F.col("start") + 1),
            "strand": F.col("strand") * F.col("slice_strand"),
        }
    )


def invalid_features(features: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, n: how many features break each rule; a null counts as a break."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]))
    return features.select(F.explode(broken).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def pruned_by_exon_pairs(models: DataFrame, by: Sequence[str], order: Sequence[str], blessed: Sequence[str], short: tuple[int, int]) -> DataFrame:
    """gene_id of the models that stay. models: gene_id, by, start, end, biotype, exons (array of start, end).

    In a cluster of overlapping models with a multi-exon one, models are visited in order; one stays if it has a pair of
    neighbouring exons that no pair found so far overlaps in both exons. Pairs with an intron strictly between the bounds
    of short never count as new; blessed biotypes always stay. In a cluster of single exons the longest stays, and the
    blessed. Sequential within one cluster, which is what a task holds."""
    spans = F.array_sort(F.transform("exons", lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"))))
    pick = lambda c: F.transform(spans, lambda e: e[c]).alias(f"{c}s")
    names = list(dict.fromkeys(["gene_id", *by, "start", "end", "biotype", *order]))
    islands = with_island(models.select(*names, pick("start"), pick("end")), by)

    def run(group: Group) -> Iterator[tuple]:
        exons = [list(zip(s, e, strict=True)) for s, e in zip(group["starts"], group["ends"], strict=True)]
        models = list(zip(group["gene_id"], group["biotype"], exons, strict=True))
        if max(map(len, exons)) == 1:
            longest = min(range(len(exons)), key=lambda i: (exons[i][0][0] - exons[i][0][1], i))
            yield from ((g,) for i, (g, kind, _) in enumerate(models) if i == longest or kind in blessed)
            return
        seen: dict[tuple[int, int], list] = {}
        for gene, kind, own in models:
            new = False
            for a, b in zip(own, own[1:], strict=False):
                if short[0] < b[0] - a[1] - 1 < short[1]:
                    continue
                # pairs are kept by the bins that their exons touch, so few of them are compared
                bins = [(x, y) for x in range(a[0] // PAIR_BIN, a[1] // PAIR_BIN + 1) for y in range(b[0] // PAIR_BIN, b[1] // PAIR_BIN + 1)]
                if not any(p[0] <= a[1] and a[0] <= p[1] and q[0] <= b[1] and b[0] <= q[1] for at in bins for p, q in seen.get(at, ())):
                    new = True
                    for at in bins:
                        seen.setdefault(at, []).append((a, b))
            if new or kind in blessed:
                yield (gene,)

    return in_groups(islands, [*by, "island"], [*order, "gene_id"], run, models.select("gene_id").schema)


def built_genes(models: DataFrame, by: Sequence[str], order: Sequence[str], blessed: Sequence[str], short: tuple[int, int], most: int) -> DataFrame:
    """gene_id, gene: a gene set from models (gene_id, by, start, end, biotype, exons, coding, has_utr, and the columns of
    order): prune by exon pairs, remove readthroughs, drop redundant coding models, drop equal models, keep the best most
    of each cluster, and cluster again by exon overlap."""
    from .building import duplicates_removed, readthroughs
    from .clusters import exon_clusters
    from .graph import checkpointed

    models = checkpointed(models)
    now = checkpointed(models.join(pruned_by_exon_pairs(models, by, order, blessed, short), "gene_id", "left_semi"))
    now = now.join(readthroughs(now, by, "gene_id"), "gene_id", "left_anti")
    now = without_redundant_coding(now, by, "coding", "has_utr", blessed)
    now = checkpointed(duplicates_removed(now, [*by, "exons"], "gene_id"))
    pieces = now.select("gene_id", *by, F.explode("exons").alias("e")).select("gene_id", *by, "e.start", "e.end")
    clusters = exon_clusters(pieces, by)
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(*order, "gene_id"))
    best = checkpointed(now.join(clusters, "gene_id").withColumn("_n", place).filter(F.col("_n") <= most).select("gene_id"))
    again = exon_clusters(pieces.join(best, "gene_id", "left_semi"), by)
    return again.select("gene_id", F.col("cluster").alias("gene"))


def painted(hits: DataFrame, by: Sequence[str], score: str, row_id: str) -> DataFrame:
    """row_id, by, start, end: the stretches of hits that no hit of a higher score (then smaller id) covers, neighbouring ones
    of one hit joined. Sequential within an island of overlapping hits; a sweep with a heap, so an island takes time in
    proportion to its hits."""
    by = list(by)
    islands = with_island(hits.select(row_id, *by, "start", "end", score), by)
    kinds = dict(hits.dtypes)

    def run(group: Group) -> Iterator[tuple]:
        where = tuple(group[b][0] for b in by)
        rows = sorted(zip(group["start"], group["end"], group[score], group[row_id], strict=True))
        borders = sorted({x for s, e, _, _ in rows for x in (s, e + 1)})
        heap, at, last = [], 0, None  # open hits by score; last: the stretch that is not yet given
        for low, high in zip(borders, borders[1:], strict=False):
            while at < len(rows) and rows[at][0] <= low:
                s, e, value, name = rows[at]
                heapq.heappush(heap, (-value, name, e))
                at += 1
            while heap and heap[0][2] < low:
                heapq.heappop(heap)
            if not heap:
                continue
            name = heap[0][1]
            if last and last[0] == name and last[2] == low - 1:
                last = (name, last[1], high - 1)
                continue
            if last:
                yield last[0], *where, last[1], last[2]
            last = (name, low, high - 1)
        if last:
            yield last[0], *where, last[1], last[2]

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (row_id, *by)) + ", start long, end long"
    return in_groups(islands, [*by, "island"], ["start"], run, schema)


def base_runs(seqs: DataFrame, base: str, least: int) -> DataFrame:
    """seq_id, start, end (from 1) of every run of a base, or of any of several, of at least that length."""
    pattern = f"[{base}]{{{least},}}"
    found = F.regexp_extract_all("seq", F.lit(pattern), F.lit(0))
    pieces = seqs.select("seq_id", F.posexplode(F.arrays_zip(F.slice(F.split("seq", pattern, -1), 1, F.size(found)).alias("gap"), found.alias("run"))).alias("at", "p"))
    sized = pieces.select("seq_id", "at", F.length("p.gap").cast("long").alias("gap"), F.length("p.run").cast("long").alias("run"))
    through = F.sum(F.col("gap") + F.col("run")).over(Window.partitionBy("seq_id").orderBy("at"))
    return sized.withColumn("end", through).select("seq_id", (F.col("end") - F.col("run") + 1).alias("start"), "end")


STOPS = ("TAA", "TAG", "TGA")


def extended_codons(rows: DataFrame) -> DataFrame:
    """rows (seq, cds_start, cds_end from 1): a coding span that does not begin with ATG takes the codon before it if that
    is ATG, and one that does not end in a stop takes the codon after it if that is a stop. No other codon is looked at."""
    codon = lambda at: F.substr("seq", at.cast("int"), F.lit(3))
    start, end = F.col("cds_start"), F.col("cds_end")
    earlier = (codon(start) != "ATG") & (start > 3) & (codon(F.greatest(start - 3, F.lit(1))) == "ATG")
    later = ~codon(end - 2).isin(*STOPS) & codon(end + 1).isin(*STOPS)
    return rows.withColumns({"cds_start": F.when(earlier, start - 3).otherwise(start), "cds_end": F.when(later, end + 3).otherwise(end)})


def best_translation(frames: DataFrame) -> DataFrame:
    """seq_id, met, open, choice. frames: seq_id, piece (peptide between stops). The longest frame that begins with M is
    chosen, unless the longest without that condition is over twice as long."""
    at = F.instr("piece", "M")
    met = F.max(F.when(at > 0, F.length("piece") - at + 1))
    best = frames.filter(F.length("piece") > 0).groupBy("seq_id").agg(met.cast("long").alias("met"), F.max(F.length("piece")).cast("long").alias("open"))
    return best.withColumn("choice", F.when(F.col("met").isNull() | (F.col("open") > 2 * F.col("met")), "open").otherwise("met"))
