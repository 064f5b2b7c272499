"""A training corpus from raw documents: five stages, each one operator over all that the stage before kept.

Language: documents without letters go, and those of which under LEAST_KNOWN of the three-letter sequences are known from
the learned languages: other languages and junk of letters. A text that switches between learned languages stays.
Near-duplicates: of documents linked by a Jaccard similarity of their five-word shingles of 0.8 or more, one stays.
Decontamination: documents with words of a benchmark window go. Personal data: spans are replaced by their kind.
SentencePiece: ids of the public model, with a check that they decode to the text.

Defined cases, for every stage: a null text is an empty one (the first stage drops it); a very long text is read whole;
of rows with equal ids and texts one stays, of ties the smaller id, then text hash; a null id is kept; an empty table
gives an empty one; columns beside text (and n_chars, if it is there) stay as they are, whatever their names; all but the
last stage return the columns they were given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontamination, language, pii, sentencepiece_viterbi, simhash_similarity
from strandline.llm.base import shared_dir

LEAST_KNOWN = 0.6
#: Rows of one Arrow batch: what a Python worker and its executor hold at once of texts of any length.
BATCH_ROWS = 1_000


def _packed(docs: DataFrame) -> DataFrame:
    """text, and the other columns as one, so that an operator's columns clash with none of them. Batches stay small."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*others or [F.lit(None).alias("none")]).alias("row"))


def _unpacked(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = language.learned(docs.filter(~language.held_out()))
    found = language.predicted(_packed(docs), field)
    return _unpacked(found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("known") >= LEAST_KNOWN)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_similarity.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _unpacked(found.filter("n_hit = 0"), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.redacted(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[f"`{c}`" for c in docs.columns])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = sentencepiece_viterbi.encoded(_packed(docs), sentencepiece_viterbi.default_model())
    kept = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_tokens", "ids", "round_trip")]
    return found.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
