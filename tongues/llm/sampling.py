"""A bounded, repeatable sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


SALTS = 64


def smallest(rows: DataFrame, key: str, order: list, count: int) -> DataFrame:
    """For every ``key`` the ``count`` rows that come first in ``order``, with their ``rank`` from 1.

    Rows are ranked among those of equal hash first, so that what meets in one task is
    ``SALTS * count`` rows of a key at most, however many rows or tasks there are.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    for parts in ([key, "_salt"], [key]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
        salted = salted.withColumn("rank", rank).filter(F.col("rank") <= count)
    return salted.drop("_salt")


def labelled_sample(rows: DataFrame, per_class: int) -> list:
    """``(label, text)`` of at most ``per_class`` rows of each label, those with the smallest hashes of ``doc_id``.

    ``rows`` has ``doc_id``, ``label`` and ``text``. The cut of each label is found from narrow rows;
    only rows below the cuts carry their text on.
    """
    narrow = rows.select("label", F.xxhash64("doc_id").alias("h"))
    cuts = smallest(narrow, "label", ["h"], per_class).groupBy("label").agg(F.max("h").alias("cut"))
    cuts = {r["label"]: r["cut"] for r in cuts.collect()}
    below = F.lit(False)
    for label, cut in cuts.items():
        below = below | ((F.col("label") == label) & (F.xxhash64("doc_id") <= cut))
    chosen = rows.filter(below).select("label", "text", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    chosen = smallest(chosen, "label", ["h", "t"], per_class)
    return [(r["label"], r["text"]) for r in chosen.select("label", "h", "t", "text").sort("label", "h", "t").collect()]
