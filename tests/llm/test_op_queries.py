"""The registered query of each operator on the driver's smallest tables: every column against plain Python or SQL."""

import hashlib
import os
import re
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F
from strandline.llm import queries, sentencepiece_viterbi

from .test_texts import base_spans, phrase_places, template_places

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        path = f"{SF}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    wanted = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in found.collect()))) == sorted(map(repr, wanted.fetchall()))


def test_op1(spark, documents):
    found = {r["doc_id"]: r for r in rows_of(spark, "op1_bootstrapped_pii")}
    assert len(found) == len(documents)
    for doc, text, _ in documents:
        r, base = found[doc], base_spans(text)
        own = [x for x in base.split(",") if x]
        assert r["base_sha256"] == sha(base)
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(x.startswith(kind + ":") for x in own)
        every = r["spans"].split(",") if r["spans"] else []
        assert set(own) <= set(every) and r["n_found"] >= len(every) - len(own)
        order = ["email", "ip", "card", "phone", "secret"]
        assert every == sorted(every, key=lambda x: (order.index(x.split(":")[0]), int(x.split(":")[1]), int(x.split(":")[2])))
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in (x.split(":") for x in every))


def test_op4(spark, documents):
    prints = {}
    for doc, text, _ in documents:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
        k = min(3, len(words))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if words else []
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    wanted = sorted((d, f"{prints[d]:016x}", find(d)) for d in ids)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op4_simhash")) == wanted


def test_op5(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_viterbi.default_model())
    found = {r["doc_id"]: r for r in rows_of(spark, "op5_sentencepiece")}
    for doc, text, _ in documents:
        ids = library.encode(text)
        assert (found[doc]["ids"], found[doc]["n_tokens"], found[doc]["round_trip"]) == (ids, len(ids), library.decode(ids) == text)


def test_op7(spark, documents):
    found = {r["doc_id"]: r for r in rows_of(spark, "op7_rare_licence_words")}
    for doc, text, _ in documents:
        r, (n, places), more = found[doc], phrase_places(text), template_places(text)
        base = sorted({label for _, label in places})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), ",".join(base))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["labels"] == ",".join(sorted({*base, *(label for label, *_ in more)}))
        assert r["score"] == (1.0 if places else max((cover for _, _, cover, _ in more), default=0.0))


def test_op8(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = rows_of(spark, "op8_host_paths")
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for r in found:
        source = pages[r["page_id"]]
        assert r["url"] == source["url"] and r["n_chars"] == len(r["text"])
        inside = re.sub(r"<[^>]*>", " ", (source["html"] or "").partition("<article")[2].partition("</article>")[0].partition(">")[2])
        import html as entities

        assert r["text"].split() == entities.unescape(inside).split()


def test_op9(spark, documents):
    found = {r["doc_id"]: r for r in rows_of(spark, "op9_crf_language")}
    right = []
    for doc, text, lang in documents:
        r = found[doc]
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if not any(map(str.isalpha, text or "")):
            assert r["lang_pred"] == "und"
        elif r["held_out"] and lang is not None:
            right.append(r["lang_pred"] == lang)
    assert sum(right) >= 0.97 * len(right)


def test_prediction_reads_only_texts(spark):
    """The same texts under other ids, languages and sources get the same prediction from the same field."""
    from strandline.llm import language

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = language.learned(docs.filter(~language.held_out()))
    turned = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("?"), "doc_id": F.col("doc_id") + 10**6})
    key = ["text", "lang_pred", "score"]
    assert sorted(map(tuple, language.predicted(docs, field).select(key).collect())) == sorted(map(tuple, language.predicted(turned, field).select(key).collect()))
