"""Balancing, splitting, folding and weighting of labelled examples, all reproducible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.operators.ranking import first_by_key, key_cutoff, per_label, rank_by_key, sample_key
from tongues.sources.dims import CODES
from tongues.sources.scratch import stored

FIRST_SHARE = 1 / 64  # of all keys, those that a sample is looked for in at first


def balance(
    df: DataFrame, max_per_class: int = 300, label: str = "language", seed: int = 42, labels: Sequence[str] = CODES
) -> DataFrame:
    """At most ``max_per_class`` pseudo-random rows per label; smaller labels stay whole."""
    return first_by_key(df, label, "text", seed, max_per_class, labels)


def balance_distinct(
    df: DataFrame, max_per_class: int = 300, label: str = "language", seed: int = 42, labels: Sequence[str] = CODES
) -> DataFrame:
    """``balance`` of the distinct ``(label, text)`` pairs, without shuffling all of them.

    Only texts whose key lies below a bound are made distinct. Labels that have too few of them, which are small ones, are read
    once more and whole; as keys are compared in order, the rows chosen are the same as from the whole corpus.
    """
    rows = df.select(label, "text").filter(F.col(label).isNotNull())
    low = sample_key("text", seed) < F.lit(f"{int(FIRST_SHARE * 16**8):08x}")
    # a label that is not listed stops the job later
    found = stored(rows.filter(low | ~F.col(label).isin(*labels)).distinct(), "sample")
    counts = {r[label]: r["n"] for r in found.groupBy(label).agg(F.count("*").alias("n")).collect()}
    short = [code for code in dict.fromkeys(labels) if counts.get(code, 0) < max_per_class]
    if short:
        whole = stored(rows.filter(F.col(label).isin(*short)).distinct(), "sample")
        found = found.filter(~F.col(label).isin(*short)).unionByName(whole)
    return first_by_key(found, label, "text", seed, max_per_class, labels)


def stratified_split(
    df: DataFrame,
    test_size: float = 0.2,
    label: str = "language",
    seed: int = 42,
    labels: Sequence[str] = CODES,
) -> DataFrame:
    """Add ``is_test`` for ``round(test_size * n)`` rows of each label.

    The cut is one (key, text) pair per label, so rows are marked in place and never
    shuffled. Copies of one text fall on the same side.
    """
    wanted = F.round(F.col("_total") * F.lit(test_size)).cast("long")
    cut = key_cutoff(df, label, "text", seed, wanted, labels)
    here = F.struct(sample_key("text", seed).alias("_key"), F.col("text").alias("_text"))
    marked = per_label(df, cut, label, labels)
    return marked.withColumn("is_test", F.coalesce(here <= F.col("_cut"), F.lit(False))).drop("_cut")


def stratified_folds(
    df: DataFrame, folds: int = 5, label: str = "language", seed: int = 42
) -> DataFrame:
    """Add ``fold`` (0 to ``folds - 1``), dealt out in turn within each label, copies of a text one after another."""
    ranked = rank_by_key(df, label, "text", seed, "_rank")
    return ranked.withColumn("fold", (F.col("_rank") - 1) % folds).drop("_rank")


def label_weights(df: DataFrame, label: str = "language") -> DataFrame:
    """``weight`` = n / (labels * n_label), one row per label."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.withColumn("_t", totals).select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight")
    )


def class_weights(df: DataFrame, label: str = "language", labels: Sequence[str] = CODES) -> DataFrame:
    """Add the balancing ``weight`` of each row's label."""
    return per_label(df, label_weights(df, label).drop("n"), label, labels)


def split_summary(df: DataFrame, features: int, label: str = "language") -> DataFrame:
    return df.groupBy(label).agg(
        F.count_if(~F.col("is_test")).alias("a"), F.count_if("is_test").alias("b")
    ).agg(
        F.sum("a").alias("train_rows"),
        F.sum("b").alias("test_rows"),
        F.lit(features).cast("long").alias("features"),
        F.count("*").alias("labels"),
    )
