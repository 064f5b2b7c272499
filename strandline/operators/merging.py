"""Two sets of models made one: pairwise structural matching of manual and automatic models, and coding models that take
untranslated exons from cDNAs.

Pairs are found by equi-joins on what must be equal, with one side reduced to one row a key before, so a structure that
many models share makes no pairs of all."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import checkpointed
from .models import chain_key, clipped, introns, total_length

#: An end that gains no intron may grow by this many bases at most.
LONGEST_EXTENSION = 10_000


def _shaped(models: DataFrame) -> DataFrame:
    """models with what matching compares: number of exons, intron chain, coding exons by number and chain."""
    coding = F.col("cds_start").isNotNull()
    parts = clipped(F.col("exons"), F.col("cds_start"), F.col("cds_end"))
    inner = F.slice("_parts", 2, F.greatest(F.size("_parts") - 2, F.lit(0)))
    return models.withColumns({"_parts": F.when(coding, parts), "n": F.size("exons"), "chain": chain_key(introns(F.col("exons"))), "start": F.array_min(F.transform("exons", lambda e: e["start"])), "end": F.array_max(F.transform("exons", lambda e: e["end"])), "length": total_length("exons")}).withColumns(
        {"coding": coding, "n_coding": F.coalesce(F.size("_parts"), F.lit(0)), "coding_chain": F.when(F.size("_parts") > 1, chain_key(inner)), "parts_chain": F.when(coding, chain_key(introns(F.col("_parts"))))}
    )


def matched_models(models: DataFrame, locus: Sequence[str]) -> DataFrame:
    """auto_id, relation, manual_id: how automatic models match manual ones of their locus; of each relation the manual model
    with the smallest id.

    models: gene_id, locus, manual, exons (rank, start, end), cds_start, cds_end (null without coding), complete (from a
    start to a stop codon), listed (in the set of agreed coding regions), small (a small RNA). Only models with equal
    numbers of exons match, and:
    replaced: the manual one stays for both. Both without coding, with equal introns (one exon: equal ends); the manual one
      coding throughout and the automatic one, without coding, alike; the manual one without coding and the automatic one
      coding, but not listed, with equal introns (one exon: always); both coding with the same coding exons and equal
      introns (one exon: the same exon, or a longer one around an automatic model that is coding throughout).
    kept: the automatic one stays for both. A small RNA of one exon and equal length, or single exons with the same coding
      but other ends where the automatic one has untranslated ends.
    variant: both stay. The same coding start, end, number of exons and inner coding exons, but other introns.
    incomplete: the automatic one goes. Its coding is neither complete nor listed, whatever the manual one's exons are."""
    locus = list(locus)
    shaped = _shaped(models).withColumns({"full": F.coalesce("complete", F.lit(False)) | F.coalesce("listed", F.lit(False)), "small": F.coalesce("small", F.lit(False)), "listed": F.coalesce("listed", F.lit(False))})
    # thirteen joins read it
    shaped = checkpointed(shaped.drop("exons", "_parts"))
    manual, auto = shaped.filter("manual"), shaped.filter("NOT manual")
    whole = F.col("coding") & F.col("full")
    bare = (F.col("start") == F.col("cds_start")) & (F.col("end") == F.col("cds_end"))

    def joined(relation: str, own: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
        on = [*locus, "n", *key]
        first = other.groupBy(*on).agg(F.min("gene_id").alias("manual_id"))
        return own.join(first, on).select(F.col("gene_id").alias("auto_id"), F.lit(relation).alias("relation"), "manual_id")

    one, many = F.col("n") == 1, F.col("n") > 1
    plain_auto, plain_manual, coding_auto, coding_manual = auto.filter("NOT coding"), manual.filter("NOT coding"), auto.filter(whole), manual.filter("coding")
    cds = ["n_coding", "cds_start", "cds_end"]
    # a small RNA of a manual model's length is kept, and not replaced by that model
    lengths = plain_manual.filter(one).select(*locus, "n", "length", "start", "end", "gene_id")
    equal = plain_auto.filter(one).join(lengths.groupBy(*locus, "n", "start", "end").agg(F.min("gene_id").alias("manual_id")), [*locus, "n", "start", "end"]).filter(~F.col("small"))
    throughout = coding_manual.filter((F.col("n") == F.col("n_coding")) & (F.col("parts_chain") == F.col("chain")))
    as_coding = throughout.filter(one).withColumns({"start": F.col("cds_start"), "end": F.col("cds_end")})
    singles = coding_auto.filter(one)
    inside = singles.filter(bare).select("gene_id", *locus, "n", *cds, "start", "end")
    around = coding_manual.filter(one).groupBy(*locus, "n", *cds).agg(F.min("gene_id").alias("manual_id"))
    same_cds = singles.join(coding_manual.filter(one).select(*locus, "n", *cds, F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("gene_id").alias("_m")).groupBy(*locus, "n", *cds, "_s", "_e").agg(F.min("_m").alias("manual_id")), [*locus, "n", *cds])
    differs = (F.col("start") != F.col("_s")) | (F.col("end") != F.col("_e"))
    variants = coding_auto.filter(many).withColumn("_own", F.col("chain")).join(
        coding_manual.filter(many).groupBy(*locus, "n", *cds, "coding_chain", F.col("chain").alias("_chain")).agg(F.min("gene_id").alias("manual_id")).withColumn("_inner", F.coalesce("coding_chain", F.lit(""))).drop("coding_chain"),
        [*locus, "n", *cds],
    ).filter((F.coalesce("coding_chain", F.lit("")) == F.col("_inner")) & (F.col("_own") != F.col("_chain")))
    named = lambda df, relation: df.select(F.col("gene_id").alias("auto_id"), F.lit(relation).alias("relation"), "manual_id")
    found = [
        joined("replaced", plain_auto.filter(many), plain_manual, ["chain"]),
        named(equal, "replaced"),
        joined("replaced", plain_auto.filter(many), throughout.filter(many), ["chain"]),
        joined("replaced", plain_auto.filter(one), as_coding, ["start", "end"]),
        joined("replaced", coding_auto.filter(many & ~F.col("listed")), plain_manual, ["chain"]),
        joined("replaced", coding_auto.filter(one & ~F.col("listed")), plain_manual, []),
        joined("replaced", coding_auto.filter(many), coding_manual, [*cds, "chain"]),
        named(same_cds.filter(~differs), "replaced"),
        named(inside.join(around, [*locus, "n", *cds]), "replaced"),
        joined("kept", plain_auto.filter(one & F.col("small")), plain_manual, ["length"]),
        named(same_cds.filter(differs & ~bare), "kept"),
        named(variants, "variant"),
        joined("incomplete", auto.filter(F.col("coding") & ~F.col("full")), manual, []),
    ]
    return reduce(DataFrame.unionByName, found).groupBy("auto_id", "relation").agg(F.min("manual_id").alias("manual_id"))


def merged_set(models: DataFrame, matches: DataFrame, evidence: DataFrame) -> DataFrame:
    """gene_id, source (manual, automatic or merged), evidence: the set that is left. Automatic models that are replaced or
    incomplete go, and so do manual ones for which an automatic one is kept (the one named by the match). Who stays for
    both is merged and takes the other's pieces of evidence (gene_id, hit), each counted once."""
    gone = matches.filter(F.col("relation").isin("replaced", "incomplete")).select(F.col("auto_id").alias("gene_id"))
    turned = matches.filter("relation = 'kept'").join(gone, F.col("auto_id") == F.col("gene_id"), "left_anti").select(F.col("manual_id").alias("from"), F.col("auto_id").alias("to"))
    turned = turned.groupBy("from").agg(F.min("to").alias("to"))
    moved = matches.filter("relation = 'replaced'").groupBy(F.col("auto_id").alias("from")).agg(F.min("manual_id").alias("to"))
    # a manual model that goes hands on what it took
    onward = moved.join(turned.select(F.col("from").alias("to"), F.col("to").alias("_on")), "to", "left").select("from", F.coalesce("_on", "to").alias("to"))
    links = onward.unionByName(turned)
    left = models.join(gone.unionByName(turned.select(F.col("from").alias("gene_id"))).distinct(), "gene_id", "left_anti").select("gene_id", "manual")
    owned = evidence.join(links, F.col("gene_id") == F.col("from"), "left").select(F.coalesce("to", "gene_id").alias("gene_id"), "hit")
    pieces = owned.groupBy("gene_id").agg(F.count_distinct("hit").alias("evidence"))
    takers = links.select(F.col("to").alias("gene_id")).distinct().withColumn("_merged", F.lit(True))
    source = F.when(F.col("_merged"), "merged").when(F.col("manual"), "manual").otherwise("automatic")
    return left.join(takers, "gene_id", "left").join(pieces, "gene_id", "left").select("gene_id", source.alias("source"), F.coalesce("evidence", F.lit(0)).cast("long").alias("evidence"))


def _ends(models: DataFrame) -> DataFrame:
    """models (exons) with introns as rows: i_start, i_end, and whether they are the lowest or the highest of their model."""
    own = models.withColumn("_introns", introns(F.col("exons")))
    rows = own.select("*", F.posexplode("_introns").alias("_at", "_i"))
    return rows.select("*", F.col("_i.start").alias("i_start"), F.col("_i.end").alias("i_end"), (F.col("_at") == 0).alias("lowest"), (F.col("_at") == F.size("_introns") - 1).alias("highest")).drop("_introns", "_i", "_at")


def utr_offers(acceptors: DataFrame, donors: DataFrame, by: Sequence[str], longest: int = LONGEST_EXTENSION) -> DataFrame:
    """acceptor, donor, priority, shared and, for either side (low, high), whether the donor can extend it, with how many
    untranslated exons and bases. acceptors: gene_id, by, exons (of the coding span only, with an intron); donors: the same
    with priority (1 is best).

    A side is extended if the donor shares the acceptor's outermost intron there and its exon at that intron reaches
    strictly further; an end that gains no intron may grow by longest bases. In a layer of equal priority donors are seen
    by introns shared; the first that extends neither side by an outermost intron ends the layer."""
    by = list(by)
    a = _ends(acceptors.select("gene_id", *by, "exons"))
    d = _ends(donors.select("gene_id", *by, "priority", "exons").withColumnsRenamed({"gene_id": "donor", "exons": "donor_exons"}).withColumn("exons", F.col("donor_exons"))).drop("exons", "lowest", "highest")
    met = a.join(d, [*by, "i_start", "i_end"])
    pairs = met.groupBy(F.col("gene_id").alias("acceptor"), "donor", "priority").agg(
        F.count(F.lit(1)).alias("shared"), F.max("lowest").alias("met_low"), F.max("highest").alias("met_high"), F.first("exons").alias("exons"), F.first("donor_exons").alias("donor_exons")
    )
    blocked = F.max(F.when(~F.col("met_low") & ~F.col("met_high"), F.col("shared"))).over(Window.partitionBy("acceptor", "priority"))
    pairs = pairs.withColumn("_blocked", blocked).filter(F.col("_blocked").isNull() | (F.col("shared") >= F.col("_blocked"))).filter("met_low OR met_high")
    ordered = lambda c: F.array_sort(F.transform(c, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"))))
    pairs = pairs.withColumns({"exons": ordered("exons"), "donor_exons": ordered("donor_exons")})
    first, last = F.get("exons", F.lit(0)), F.try_element_at("exons", F.lit(-1))
    low = F.filter("donor_exons", lambda e: e["end"] <= first["end"])
    high = F.filter("donor_exons", lambda e: e["start"] >= last["start"])
    pairs = pairs.withColumns({"_low": low, "_high": high})
    low_gain, high_gain = first["start"] - F.get("_low", F.lit(0))["start"], F.try_element_at("_high", F.lit(-1))["end"] - last["end"]
    reaches_low = F.col("met_low") & (F.try_element_at("_low", F.lit(-1))["start"] < first["start"]) & ((F.size("_low") > 1) | (low_gain <= longest))
    reaches_high = F.col("met_high") & (F.get("_high", F.lit(0))["end"] > last["end"]) & ((F.size("_high") > 1) | (high_gain <= longest))
    bases = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, e: s + e["end"] - e["start"] + 1)
    return pairs.select(
        "acceptor", "donor", "priority", "shared", F.coalesce(reaches_low, F.lit(False)).alias("low"), F.coalesce(reaches_high, F.lit(False)).alias("high"),
        F.size("_low").alias("low_exons"), F.size("_high").alias("high_exons"),
        (bases("_low") - (first["end"] - first["start"] + 1)).alias("low_bases"), (bases("_high") - (last["end"] - last["start"] + 1)).alias("high_bases"),
        F.col("_low").alias("low_part"), F.col("_high").alias("high_part"),
    )


def chosen_offers(offers: DataFrame) -> DataFrame:
    """acceptor, low_donor, high_donor, low_part, high_part (null where a side is not extended).

    Layers of priority are taken in order. A donor that extends both sides is taken in the first layer that has one, unless
    an earlier layer extended a side already: by most introns shared, then most untranslated exons, then most bases, then
    the smallest id (ids are numbers) - but not if donors for single sides that share more introns extend both sides in the same layer.
    Otherwise each side takes the best donor of the first layer that extends it, by the same order, until both have one."""
    both, single = F.col("low") & F.col("high"), F.col("low") != F.col("high")
    layers = offers.groupBy("acceptor").agg(F.min(F.when(both, F.col("priority"))).alias("_both"), F.min(F.when(single, F.col("priority"))).alias("_single"))
    staged = offers.join(layers, "acceptor")

    def best(side: Column, exons: Column, bases: Column, value: Column) -> Column:
        order = F.struct(F.col("shared"), exons, bases, -F.col("donor"))
        return F.max_by(value, F.when(side, order))

    whole = F.struct("donor", "low_part", "high_part", "shared")
    in_both = both & (F.col("priority") == F.col("_both")) & (F.col("_both") <= F.coalesce("_single", F.col("_both")))
    low_single, high_single = F.col("low") & ~F.col("high") & (F.col("priority") == F.col("_both")), F.col("high") & ~F.col("low") & (F.col("priority") == F.col("_both"))
    pairs = staged.groupBy("acceptor").agg(
        best(in_both, F.col("low_exons") + F.col("high_exons"), F.col("low_bases") + F.col("high_bases"), whole).alias("_b"),
        F.max(F.when(low_single, F.col("shared"))).alias("_l"), F.max(F.when(high_single, F.col("shared"))).alias("_h"),
    )
    pairs = pairs.withColumn("_takes", F.col("_b").isNotNull() & ~F.coalesce((F.col("_l") > F.col("_b.shared")) & (F.col("_h") > F.col("_b.shared")), F.lit(False)))
    # sides: donors for both act for one as well, but only in layers behind the first that extends a side
    late = both & (F.col("priority") > F.col("_single"))
    low_use, high_use = F.col("low") & (single | late), F.col("high") & (single | late)
    first = staged.groupBy("acceptor").agg(F.min(F.when(low_use, F.col("priority"))).alias("_low_layer"), F.min(F.when(high_use, F.col("priority"))).alias("_high_layer"))
    sides = staged.join(first, "acceptor").groupBy("acceptor").agg(
        best(low_use & (F.col("priority") == F.col("_low_layer")), F.col("low_exons"), F.col("low_bases"), F.struct("donor", F.col("low_part").alias("part"))).alias("_low"),
        best(high_use & (F.col("priority") == F.col("_high_layer")), F.col("high_exons"), F.col("high_bases"), F.struct("donor", F.col("high_part").alias("part"))).alias("_high"),
    )
    pick = lambda a, b: F.when(F.col("_takes"), F.col(a)).otherwise(F.col(b))
    return pairs.join(sides, "acceptor").select(
        "acceptor", pick("_b.donor", "_low.donor").alias("low_donor"), pick("_b.donor", "_high.donor").alias("high_donor"), pick("_b.low_part", "_low.part").alias("low_part"), pick("_b.high_part", "_high.part").alias("high_part")
    ).filter("low_donor IS NOT NULL OR high_donor IS NOT NULL")


def single_offers(acceptors: DataFrame, donors: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """acceptor, donor, start, end: for acceptors of one exon (start, end) the donor of one exon that contains and is not
    equal to it, by priority, then length, then the smallest id."""
    from .intervals import overlaps

    pairs = overlaps(acceptors.select("gene_id", *by, "start", "end"), donors.select("gene_id", *by, "start", "end", "priority"), by, width)
    holds = pairs.filter("r_start <= start AND r_end >= end AND (r_start < start OR r_end > end)")
    order = F.struct(F.col("r_priority"), F.col("r_start") - F.col("r_end"), F.col("r_gene_id"))
    return holds.groupBy(F.col("gene_id").alias("acceptor")).agg(F.min_by(F.struct("r_gene_id", "r_start", "r_end"), order).alias("d")).select("acceptor", F.col("d.r_gene_id").alias("donor"), F.col("d.r_start").alias("start"), F.col("d.r_end").alias("end"))


def with_utr(acceptors: DataFrame, donors: DataFrame, by: Sequence[str], longest: int = LONGEST_EXTENSION, width: int = 1024) -> DataFrame:
    """gene_id, low_donor, high_donor, exons (start, end), low_utr, high_utr (bases), cds_in_cdna: acceptors (gene_id, by,
    strand among them, exons, cds_start, cds_end) cut to their coding span and extended by untranslated exons of donors
    (gene_id, by, priority, exons). cds_in_cdna is where coding begins in the new model, which the untranslated bases at
    its 5' end shift; coding itself does not change."""
    by = list(by)
    plain = lambda c: F.array_sort(F.transform(c, lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"))))
    own = acceptors.select("gene_id", *by, plain(clipped(F.col("exons"), F.col("cds_start"), F.col("cds_end"))).alias("exons"))
    given = donors.select("gene_id", *by, "priority", plain(F.col("exons")).alias("exons"))
    # equal donors count once, and acceptors with equal coding exons are looked up once
    given = given.groupBy(*by, "priority", "exons").agg(F.min("gene_id").alias("gene_id"))
    own = own.withColumn("_like", F.min("gene_id").over(Window.partitionBy(*by, "exons")))
    unlike = own.filter("gene_id = _like").drop("_like")
    several = chosen_offers(utr_offers(unlike.filter(F.size("exons") > 1), given.filter(F.size("exons") > 1), by, longest))
    flat = lambda df, *more: df.filter(F.size("exons") == 1).select("gene_id", *by, *more, F.get("exons", F.lit(0))["start"].alias("start"), F.get("exons", F.lit(0))["end"].alias("end"))
    single = single_offers(flat(unlike), flat(given, "priority"), by, width)
    one = single.select("acceptor", F.col("donor").alias("low_donor"), F.col("donor").alias("high_donor"), F.array(F.struct("start", "end")).alias("_whole"))
    kind = dict(own.dtypes)["exons"]
    offers = several.withColumn("_whole", F.lit(None).cast(kind)).unionByName(one.withColumns({"low_part": F.lit(None).cast(kind), "high_part": F.lit(None).cast(kind)}))
    joined = own.join(offers, F.col("_like") == F.col("acceptor"), "left")
    middle = F.slice("exons", 2, F.greatest(F.size("exons") - 2, F.lit(0)))
    first, last = F.slice("exons", 1, 1), F.slice("exons", -1, 1)
    longer = F.concat(F.coalesce("low_part", first), middle, F.coalesce("high_part", last))
    grown = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(F.col("acceptor").isNull(), F.col("exons")).otherwise(longer)
    low, high = F.get("exons", F.lit(0))["start"], F.try_element_at("exons", F.lit(-1))["end"]
    before = F.aggregate("grown", F.lit(0).cast("long"), lambda s, e: s + F.greatest(F.least(e["end"], low - 1) - e["start"] + 1, F.lit(0)))
    after = F.aggregate("grown", F.lit(0).cast("long"), lambda s, e: s + F.greatest(e["end"] - F.greatest(e["start"], high + 1) + 1, F.lit(0)))
    found = joined.withColumn("grown", grown).withColumns({"low_utr": before, "high_utr": after})
    return found.select("gene_id", "low_donor", "high_donor", F.col("grown").alias("exons"), "low_utr", "high_utr", (F.when(F.col("strand") == 1, F.col("low_utr")).otherwise(F.col("high_utr")) + 1).alias("cds_in_cdna"))
