"""Augmented corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.functions import variants as V


def variants_of(df: DataFrame, *families: str) -> DataFrame:
    """One row per variant of the chosen families (all by default), repeats included."""
    chosen = families or tuple(V.FAMILIES)
    return df.select("language", F.explode(V.variants(F.col("text"), chosen)).alias("text"))


def augment(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Base sentences and all their variants, distinct, with ``is_base`` marking the former.

    Repeats are removed by one aggregation on (language, text). For a large ``df``, ``tasks`` deals the sentences out to so many
    tasks, by a key that a sentence shares with its variants: equal variants of different sentences meet in one task, and variants,
    which are more than ten times as many, are made and compared where they are, never moved or written.
    """
    keys = ["language"]
    if tasks:
        df = df.withColumn("_key", V.variant_key(F.col("text"))).repartition(tasks, "_key")
        keys = ["_key", "language"]
    base = F.array(F.struct(F.col("text").alias("text"), F.lit(True).alias("is_base")))
    made = F.transform(
        V.variants(F.col("text")), lambda v: F.struct(v.alias("text"), F.lit(False).alias("is_base"))
    )
    exploded = df.select(*keys, F.explode(F.concat(base, made)).alias("v"))
    rows = exploded.select(*keys, "v.text", "v.is_base")
    return rows.groupBy(*keys, "text").agg(F.max("is_base").alias("is_base")).drop("_key")
