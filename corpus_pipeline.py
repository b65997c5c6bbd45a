"""A corpus pipeline over ``documents``; every stage's output is written and read again.

Language identification drops what has no recognisable language; lines that an earlier document
already has go; one document of each group of near copies stays; documents are dropped or
repeated so that domains have their target weights; what remains is encoded as token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.llm.language import UNKNOWN, predict, train
from tongues.llm.lines import dedup_lines
from tongues.llm.mixing import mixed_documents
from tongues.llm.sentencepiece import tokenize
from tongues.llm.simhash import keep_one, near_groups
from tongues.sources.scratch import scratch
from tongues.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document needs this calibrated probability of its best language to stay.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language of probability ``LEAST_SCORE`` or more; null texts go."""
    found = predict(docs.select(*COLUMNS), train(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id owns; ``n_chars`` is counted anew."""
    kept = dedup_lines(docs.select(*COLUMNS), keep=COLUMNS)
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Near copies have fingerprints within 3 bits, as in ``op3``, or similar five-word shingles (0.8 or more).
    """
    docs = docs.select(*COLUMNS)
    return keep_one(docs, near_groups(docs))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: clean ones at least about once, junk rarely, toxic ones hardly ever."""
    return mixed_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and whether they decode to the text."""
    return tokenize(docs)


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix_domains),
    ("tokens", encode_tokens),
]
#: SQL has no model training, 64-bit XXH64 or token segmentation; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` one after another over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
