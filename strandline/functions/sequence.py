"""Sequence scalars as column expressions: complement, translation, reading frames, tails, runs, masks and CIGAR strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code, codons in the order of T, C, A, G at each place.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
ORDER = "TCAG"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUNacgtun", "TGCAANtgcaan"))


def translated(seq: Column, frame: int = 0) -> Column:
    """Peptide of a frame (0 to 2): stops are *, codons with other letters X, an incomplete codon is dropped. Codons are
    cut out once; a lambda over positions would take the whole sequence apart again for each."""
    codons = F.regexp_extract_all(F.upper(F.substr(seq, F.lit(frame + 1), F.length(seq))), F.lit("(?s).{3}"), F.lit(0))

    def one(codon: Column) -> Column:
        at = F.conv(F.translate(codon, "TCAGU", "01230"), 4, 10).cast("int")
        return F.when(codon.rlike("^[TCAGU]{3}$"), F.substr(F.lit(CODE), at + 1, F.lit(1))).otherwise(F.lit("X"))

    return F.array_join(F.transform(codons, one), "")


def open_frames(peptide: Column, from_met: bool = True) -> Column:
    """Array of start (from 0), length, peptide of the pieces between stops; from_met: from each piece's first M, pieces
    without one left out."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,peptide:string>>").alias("out"))

    def add(done: Column, piece: Column) -> Column:
        met = F.instr(piece, "M")
        skip = F.greatest(met - 1, F.lit(0)) if from_met else F.lit(0)
        kept = F.substr(piece, skip + 1, F.length(piece))
        one = F.struct((done["at"] + skip).alias("start"), F.length(kept).alias("length"), kept.alias("peptide"))
        good = met > 0 if from_met else F.length(piece) > 0
        return F.struct((done["at"] + F.length(piece) + 1).alias("at"), F.when(good, F.concat(done["out"], F.array(one))).otherwise(done["out"]).alias("out"))

    return F.aggregate(F.split(peptide, r"\*", -1), none, add, lambda done: done["out"])


def base_count(seq: Column, base: str) -> Column:
    return (F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))).cast("long")


def gc_percent(seq: Column) -> Column:
    return F.round(100 * F.try_divide(base_count(seq, "G") + base_count(seq, "C"), F.length(seq)), 4)


def tail_length(seq: Column, base: str = "A") -> Column:
    """Bases of the run of one base at the end."""
    return F.length(F.regexp_extract(seq, f"({base}*)$", 1)).cast("long")


def has_polya_signal(seq: Column, signal: str = "AATAAA", nearest: int = 10, farthest: int = 30) -> Column:
    """Whether the signal lies between farthest and nearest bases before the end."""
    return F.contains(F.substr(seq, F.greatest(F.length(seq) - farthest + 1, F.lit(1)), F.lit(farthest - nearest)), F.lit(signal))


def canonical_splice(donor: Column, acceptor: Column) -> Column:
    return F.concat(F.upper(donor), F.upper(acceptor)).isin("GTAG", "GCAG", "ATAC")


def masked(seq: Column, blocks: Column, soft: bool = False) -> Column:
    """seq with sorted, disjoint blocks (start, end from 1) as N, or in lower case if soft."""
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def add(done: Column, b: Column) -> Column:
        gap = F.substr(seq, (done["at"] + 1).cast("int"), (b["start"] - done["at"] - 1).cast("int"))
        own = F.substr(seq, b["start"].cast("int"), (b["end"] - b["start"] + 1).cast("int"))
        inner = F.lower(own) if soft else F.repeat(F.lit("N"), F.length(own))
        return F.struct(b["end"].cast("bigint").alias("at"), F.concat(done["out"], gap, inner).alias("out"))

    return F.aggregate(blocks, none, add, lambda d: F.concat(d["out"], F.substr(seq, (d["at"] + 1).cast("int"), F.length(seq))))


def cigar_ops(cigar: Column) -> Column:
    """Array of n, op of a CIGAR string."""
    parts = F.regexp_extract_all(cigar, F.lit(r"\d+[A-Z=]"), F.lit(0))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"\d+", 0).cast("long").alias("n"), F.right(p, F.lit(1)).alias("op")))


def merged_codons(cigar: Column) -> Column:
    """A CIGAR with codon matches (C) as one of plain matches: C becomes M, and neighbouring equal operations join.
    Without C it stays as it is."""
    ops = F.transform(cigar_ops(cigar), lambda o: F.struct(o["n"].alias("n"), F.when(o["op"] == "C", "M").otherwise(o["op"]).alias("op")))
    none = F.slice(ops, 1, 0)

    def add(done: Column, o: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct((last["n"] + o["n"]).alias("n"), o["op"].alias("op"))))
        return F.when(last["op"] == o["op"], joined).otherwise(F.concat(done, F.array(o)))

    text = F.array_join(F.transform(F.aggregate(ops, none, add), lambda o: F.concat(o["n"].cast("string"), o["op"])), "")
    return F.when(F.contains(cigar, F.lit("C")), text).otherwise(cigar)


def slice_name(name: Column) -> Column:
    """coord:version:name:start:end:strand as a struct."""
    parts = F.split(name, ":")
    fields = ["coord", "version", "name", "start", "end", "strand"]
    return F.struct(*[(F.get(parts, F.lit(i)).cast("long") if f in ("start", "end") else F.get(parts, F.lit(i)).cast("int") if f == "strand" else F.get(parts, F.lit(i))).alias(f) for i, f in enumerate(fields)])


def without_version(accession: Column) -> Column:
    return F.regexp_replace(accession, r"\.\d+$", "")
