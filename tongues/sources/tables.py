"""Parquet tables as inputs: labelled documents, web pages and unlabelled turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.sources.dims import with_language


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core when the input has fewer splits than there are cores.

    A table of many files or row groups is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def text_tasks(df: DataFrame, text: str = "text", size: int = 8_000_000) -> int:
    """Tasks for work on all texts: ``size`` bytes of them each, and all cores at least."""
    held = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-held // size))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def read_documents(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc_id, language, text)`` of the documents in a known language."""
    docs = table(spark, directory, "documents").select("doc_id", "text", "lang").filter(F.col("text").isNotNull())
    return with_language(spread(docs, "doc_id"), "lang").select("doc_id", "language", "text")


def read_pages(spark: SparkSession, directory: str) -> DataFrame:
    """``(page_id, url, html)`` of the pages that were fetched; a failed fetch has blank html."""
    pages = table(spark, directory, "pages").select("page_id", "url", "html")
    return spread(pages.filter(F.col("html") != ""), "page_id")


def with_url_language(pages: DataFrame) -> DataFrame:
    """Language of a page from the two-letter first segment of its path."""
    iso = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1)
    return with_language(pages.withColumn("iso", iso), "iso").drop("iso")
