"""Licence texts by a positional index of rare words.

Of each licence template the index holds the two words of its mandatory key phrase with the highest IDF (over all
documents) as anchors, with their places. A document looks up its anchor words; each hit of a template's rarest anchor
proposes the offset at which the template would start, and stands if the other anchor has its relative position, all
words of the key phrase stand at their places, and COVER of the template's indexed words do. A notice that meets these
conditions has its anchors in place, so no notice is lost, however many a document holds. Beside these labels three fixed
phrases are found wherever their words stand together.

Everything is DataFrame and SQL functions. Texts are read twice (word counts, then hits) and neither shuffled nor
written; the templates have a fixed size and are part of the plan. Document frequencies come to the driver for the words
of the templates alone.

Defined cases: a null text is an empty one, without words; a very long text is read whole; words of equal IDF rank by
name; repeated rows get equal results; overlapping places all count; other columns are not read, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVER = 0.6

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices as licences ask for them; label, notice, mandatory key phrase.
TEMPLATES = [
    ("mit", "released under the MIT License", "mit license"),
    ("mit", "licensed under the MIT License", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the Apache License Version 2.0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the GNU General Public License version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl", "licensed under the GNU Affero General Public License", "gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License v 2.0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "licensed under the BSD License", "bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("cc0-1.0", "dedicated to the public domain under CC0 1.0", "cc0 1 0"),
    ("cc-by-4.0", "licensed under CC BY 4.0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under CC BY-NC-SA 4.0", "cc by nc sa 4 0"),
    ("cc-by-4.0", "creative commons attribution 4.0 international license", "creative commons attribution 4 0"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "permission notice shall be included in all copies or substantial portions"),
    ("apache-2.0", "you may not use this file except in compliance with the License", "except in compliance with the license"),
    ("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation either version 3 of the License", "free software foundation either version 3"),
    ("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation either version 2 of the License", "free software foundation either version 2"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license as published"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license as published"),
    ("mpl-2.0", "this source code form is subject to the terms of the Mozilla Public License v 2.0", "source code form is subject"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions of source code must retain"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "redistributions in binary form must reproduce"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "alter it and redistribute it freely"),
    ("bsl-1.0", "distributed under the Boost Software License Version 1.0", "boost software license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]
#: Common words that the index leaves out.
COMMON = frozenset("a all an and any are as at be for from in into is it of on or that the this to was with without".split())

def _words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


def postings(templates=TEMPLATES) -> list[dict]:
    """Of each template its label, indexed words and key phrase with their places."""
    out = []
    for label, notice, key in templates:
        words, phrase = _words(notice), _words(key)
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        own = [(w, i) for i, w in enumerate(words) if w not in COMMON]
        out.append({"label": label, "indexed": own, "key": [(w, at + i) for i, w in enumerate(phrase)]})
    return out


def _lower(text: str) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def document_frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How many documents have each of the words that any has: one row a word comes to the driver."""
    own = F.array_intersect(F.split(_lower("text"), GAPS), F.array(*map(F.lit, words)))
    rows = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["word"]: r["n"] for r in rows}


def _literal(pairs: list[tuple[str, int]]) -> Column:
    return F.array(*[F.struct(F.lit(w).alias("word"), F.lit(i).alias("place")) for w, i in pairs])


def index_of(templates: list[dict], frequent: dict[str, int]) -> tuple[list[str], Column]:
    """The rarest anchors, and one row for each template: label, the places of its anchors, indexed words, key phrase."""
    rows, first = [], set()
    for number, own in enumerate(templates):
        rarest = sorted((p for p in own["key"] if p[0] not in COMMON), key=lambda p: (frequent.get(p[0], 0), p)) or own["key"]
        (a, a_at), (b, b_at) = rarest[0], rarest[min(1, len(rarest) - 1)]
        first.add(a)
        rows.append(F.struct(
            F.lit(number).alias("template"), F.lit(own["label"]).alias("label"), F.lit(a).alias("a"), F.lit(a_at).alias("a_at"), F.lit(b).alias("b"), F.lit(b_at).alias("b_at"),
            _literal(own["indexed"]).alias("indexed"), _literal(own["key"]).alias("key"),
        ))
    return sorted(first), F.array(*rows)


def _phrase_places(words: Column, low: Column, phrase: str) -> Column:
    """Places (from 0) at which the phrase's words stand consecutively."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(words, i + j) == part, F.lit(False))
        return same

    may = F.lit(True)
    for part in parts:
        may = may & F.contains(low, F.lit(part))
    return F.when(may & (F.size(words) > 0), F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)).otherwise(F.array().cast("array<int>"))


def licensed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, places (of the fixed phrases: at, label), found (of the templates: label, at, cover, template)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = postings(templates)
    vocabulary = sorted({w for own in known for w, _ in own["key"]})
    anchors, index = index_of(known, document_frequencies(docs, vocabulary))
    low, words, hits = F.col("low"), F.col("words"), F.col("anchor_words")
    rows = docs.select("doc_id", _lower("text").alias("low"))
    rows = rows.withColumn("words", F.array_remove(F.split(low, GAPS), ""))
    rows = rows.withColumn("anchor_words", F.array_intersect(words, F.array(*map(F.lit, anchors))))

    def stands(at: Column, pairs: Column) -> Column:
        return F.filter(pairs, lambda p: F.coalesce(F.get(words, at + p["place"]) == p["word"], F.lit(False)))

    def aligned(i: Column) -> Column:
        own = F.get(words, i)
        near = F.filter(index, lambda t: (t["a"] == own) & F.coalesce(F.get(words, i - t["a_at"] + t["b_at"]) == t["b"], F.lit(False)))
        whole = F.filter(near, lambda t: F.size(stands(i - t["a_at"], t["key"])) == F.size(t["key"]))
        return F.transform(whole, lambda t: F.struct(
            t["label"].alias("label"), (i - t["a_at"]).alias("at"), (F.size(stands(i - t["a_at"], t["indexed"])) / F.size(t["indexed"])).alias("cover"), t["template"].alias("template")
        ))

    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(hits, F.get(words, i)))
    none = F.array().cast("array<struct<label:string,at:int,cover:double,template:int>>")
    found = F.when(F.size(hits) > 0, F.filter(F.flatten(F.transform(at, aligned)), lambda x: x["cover"] >= COVER)).otherwise(none)
    places = F.concat(*[F.transform(_phrase_places(words, low, phrase), _labelled(label)) for phrase, label in PHRASES.items()])
    return rows.select("doc_id", F.size(words).cast("long").alias("n_words"), F.array_sort(places).alias("places"), F.array_sort(found).alias("found"))


def _labelled(label: str):
    return lambda i: F.struct(i.alias("at"), F.lit(label).alias("label"))


def op7_rare_licence_words(spark, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    found = licensed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("found", lambda p: p["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    cover = F.array_max(F.transform("found", lambda p: p["cover"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(cover, F.lit(0.0))).alias("score"),
    )
