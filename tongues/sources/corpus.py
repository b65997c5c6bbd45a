"""Corpora on disk: one UTF-8 sentence per line, one file or folder per language."""

from __future__ import annotations

import json
from collections.abc import Sequence
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.functions.text import strip
from tongues.sources.dims import CODES

SENTENCE = "language string, text string"


def read_corpus(spark: SparkSession, directory: str, languages: Sequence[str] = CODES) -> DataFrame:
    """``(language, text)`` from ``<language>.txt`` files or ``language=<language>`` folders.

    Lines are trimmed and blank ones dropped. Languages without a file are skipped;
    nothing at all for any of them is an error.
    """
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"/language=([^/]+)/[^/]*$", 1)
    name = F.regexp_extract(path, r"/([^/]+)\.txt$", 1)
    lines = (
        spark.read.option("recursiveFileLookup", "true").text(directory)
        .select(F.when(folder != "", folder).otherwise(name).alias("language"), strip(F.col("value")).alias("text"))
        .filter(F.col("language").isin(*languages) & (F.col("text") != ""))
    )
    if lines.isEmpty():
        raise ValueError(f"no sentences for {', '.join(languages)} under {directory}")
    return lines


def read_seed(spark: SparkSession) -> DataFrame:
    """The packaged fallback corpus: 25 sentences for each language."""
    data = json.loads(resources.files("tongues").joinpath("data/seed.json").read_text(encoding="utf-8"))
    return spark.createDataFrame([(lang, text) for lang, texts in data.items() for text in texts], SENTENCE)


def write_corpus(sentences: DataFrame, *directories: str, files_per_language: int | None = None) -> None:
    """Write ``language=<language>`` folders of text files, the same content to every directory.

    Each task writes its own rows, so a language that holds most of the corpus is not
    gathered anywhere. ``files_per_language`` shuffles rows into that many files each.
    """
    rows = sentences.select("language", "text")
    if files_per_language:
        part = F.pmod(F.xxhash64("text"), F.lit(files_per_language))
        rows = rows.repartition("language", part)
    first, *others = directories
    rows.write.mode("overwrite").partitionBy("language").text(first)
    for other in others:
        spark = sentences.sparkSession
        written = spark.read.schema("value string, language string").text(first).select("language", "value")
        written.write.mode("overwrite").partitionBy("language").text(other)


def corpus_stats(sentences: DataFrame) -> DataFrame:
    """One row ``(total_sentences, languages, timestamp, date)``."""
    counts = sentences.groupBy("language").agg(F.count("*").alias("n"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "n"))))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_sentences"), entries.alias("languages")
    ).select(
        "total_sentences",
        "languages",
        F.current_timestamp().cast("double").alias("timestamp"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("date"),
    )


def write_stats(sentences: DataFrame, directory: str) -> None:
    corpus_stats(sentences).coalesce(1).write.mode("overwrite").json(directory)
