"""Counts and length statistics of corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.sources.dims import NAMES
from tongues.functions.report import language_name


def corpus_counts(df: DataFrame) -> DataFrame:
    """Sentences per language and in total (``language`` null). Rolls up counts, not rows."""
    counts = df.groupBy("language").agg(F.count("*").alias("n"))
    return counts.rollup("language").agg(F.sum("n").alias("sentences"))


def augment_counts(augmented: DataFrame) -> DataFrame:
    """Sentences before and after augmentation, per language and in total."""
    counts = augmented.groupBy("language").agg(
        F.count_if("is_base").alias("b"), F.count("*").alias("a")
    )
    return counts.rollup("language").agg(F.sum("b").alias("before"), F.sum("a").alias("after"))


def length_stats(augmented: DataFrame) -> DataFrame:
    return augmented.groupBy("language").agg(
        F.count("*").alias("sentences"),
        F.avg(F.length("text")).alias("avg_length"),
        F.count_if("is_base").alias("base_sentences"),
        F.count_if(~F.col("is_base")).alias("augmented"),
    )


def load_summary(examples: DataFrame, label: str = "language") -> DataFrame:
    """One row: total, rows per label and display names, both in label order."""
    counts = examples.groupBy(label).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "n")))
    return counts.agg(F.sum("n").alias("total"), ordered.alias("per_label")).withColumn(
        "names", F.transform("per_label", lambda s: language_name(s["label"], NAMES))
    )
