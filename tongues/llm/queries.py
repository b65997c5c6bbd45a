"""The operators over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.llm.audit import audit_filters
from tongues.llm.exact import exact_groups
from tongues.llm.html import extract
from tongues.llm.language import identify
from tongues.llm.lines import dedup_lines
from tongues.llm.mixing import mix
from tongues.llm.pii import personal_data
from tongues.llm.sentencepiece import tokenize
from tongues.llm.sharding import shard_documents
from tongues.llm.simhash import hex16, simhash_groups
from tongues.llm.spelling import spelling_groups
from tongues.llm.suffixes import remove_repeats
from tongues.llm.vptree import nearest
from tongues.sources.tables import table


def op1_pii(spark: SparkSession, directory: str) -> DataFrame:
    return personal_data(table(spark, directory, "documents"))


def op2_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mix(table(spark, directory, "documents"), table(spark, directory, "labels")).drop("twin")


def op3_simhash(spark: SparkSession, directory: str) -> DataFrame:
    groups = simhash_groups(table(spark, directory, "documents"))
    return groups.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op4_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    return tokenize(table(spark, directory, "documents"))


def op5_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact_groups(table(spark, directory, "documents"), digest=True)


def op6_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return identify(table(spark, directory, "documents"))


def op7_html_text(spark: SparkSession, directory: str) -> DataFrame:
    return extract(table(spark, directory, "pages"))


def op8_sharding(spark: SparkSession, directory: str) -> DataFrame:
    return shard_documents(table(spark, directory, "documents"))


def op9_nearest(spark: SparkSession, directory: str) -> DataFrame:
    return nearest(table(spark, directory, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    kept = dedup_lines(table(spark, directory, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, directory: str) -> DataFrame:
    return spelling_groups(table(spark, directory, "documents"))


def op12_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return remove_repeats(table(spark, directory, "documents"))


def op13_filter_audit(spark: SparkSession, directory: str) -> DataFrame:
    return audit_filters(table(spark, directory, "documents"), table(spark, directory, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_mixing, op3_simhash, op4_sentencepiece, op5_exact_dedup, op6_language_id, op7_html_text, op8_sharding,
        op9_nearest, op10_line_dedup, op11_spelling, op12_suffix_dedup, op13_filter_audit,
    )
}
