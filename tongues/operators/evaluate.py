"""Accuracy, per-class report and confusion matrix.

Everything is derived from the counts per (actual, predicted) pair: one pass over
the rows with map-side counting, then a table of at most ``k * k`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, actual: str = "language", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("correct"),
    ).withColumn("accuracy", F.coalesce(F.try_divide("correct", "total"), F.lit(0.0)))


def _class_totals(pairs: DataFrame) -> DataFrame:
    """True positives, predicted and actual rows per class, from one explode of the counts."""
    hit = F.col("actual") == F.col("predicted")
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"),
                         F.when(hit, F.col("n")).otherwise(F.lit(0)).alias("tp")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"),
                         F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    return sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("claimed").alias("claimed"), F.sum("support").alias("support")
    )


def class_report(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""
    zero = F.lit(0.0)
    classes = (
        _class_totals(pairs)
        .withColumn("precision", F.coalesce(F.try_divide("tp", "claimed"), zero))
        .withColumn("recall", F.coalesce(F.try_divide("tp", "support"), zero))
        .withColumn(
            "f1",
            F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("claimed") + F.col("support")), zero),
        )
    )
    metrics = ("precision", "recall", "f1")
    hits = F.coalesce(F.try_divide(F.sum("tp"), F.sum("support")), zero)
    whole = classes.agg(
        F.sum("support").alias("support"),
        hits.alias("hits"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[F.coalesce(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")), zero).alias(f"weighted_{m}") for m in metrics],
    )
    rows = [
        F.struct(F.lit("accuracy").alias("label"), *[F.col("hits").alias(m) for m in metrics]),
        *[
            F.struct(F.lit(f"{kind} avg").alias("label"), *[F.col(f"{kind}_{m}").alias(m) for m in metrics])
            for kind in ("macro", "weighted")
        ],
    ]
    summary = whole.select(F.explode(F.array(*rows)).alias("r"), "support").select("r.*", "support")
    return classes.select("label", *metrics, "support").unionByName(summary)


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of labels in use, zeros included."""
    seen = pairs.agg(
        F.array_union(F.collect_set("actual"), F.collect_set("predicted")).alias("labels"),
        F.map_from_entries(
            F.collect_list(F.struct(F.struct("actual", "predicted"), "n"))
        ).alias("cells"),
    )
    grid = seen.select(F.explode("labels").alias("actual"), "labels", "cells").select(
        "actual", F.explode("labels").alias("predicted"), "cells"
    )
    cell = F.try_element_at("cells", F.struct("actual", "predicted"))
    return grid.select("actual", "predicted", F.coalesce(cell, F.lit(0).cast("long")).alias("n"))


def confusion_wide(pairs: DataFrame, labels: list[str]) -> DataFrame:
    """One row per label in use, one column per label of ``labels``; a prediction outside them stops the job."""
    predicted = F.col("predicted")
    message = F.concat(F.lit("predicted label not listed: "), F.coalesce(predicted, F.lit("null")))
    checked = pairs.withColumn("predicted", F.when(predicted.isin(*labels), predicted).otherwise(F.raise_error(message)))
    cells = confusion_matrix(checked)
    return cells.groupBy("actual").pivot("predicted", sorted(labels)).agg(F.sum("n")).na.fill(0)
