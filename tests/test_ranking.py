"""Ranks of repeated texts: right for every copy, and spread over tasks."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tongues.operators import sampling as B
from tongues.operators.ranking import SALTS, rank_by_key


def order(text):
    return hashlib.md5(f"42|{text}".encode()).hexdigest(), text


def test_ranks_of_copies(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), f"text {rng.randint(0, 30)}", rng.choice([None, 1, 2])) for _ in range(600)]
    df = spark.createDataFrame(rows, "language string, text string, other int")
    found = [tuple(r) for r in rank_by_key(df, "language", "text", 42).collect()]
    assert Counter(r[:3] for r in found) == Counter(rows)
    for language in "ab":
        mine = sorted((r for r in found if r[0] == language), key=lambda r: r[3])
        assert [r[3] for r in mine] == list(range(1, len(mine) + 1))
        assert [r[1] for r in mine] == sorted((t for lang, t, _ in rows if lang == language), key=order)
    assert rank_by_key(df.limit(0), "language", "text", 42).count() == 0


def test_copies_of_one_text_are_spread(spark):
    copies = spark.range(5000).select(F.lit("english").alias("language"), F.lit("the same").alias("text"), F.col("id").alias("doc_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_by_key(copies, "language", "text", 42)
        tasks = [n for n in ranked.rdd.glom().map(len).collect() if n]
        assert len(tasks) == 8 and max(tasks) < 5000 / 4
        parts = Counter(ranked.select(F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("p")).toPandas()["p"])
        assert len(parts) == SALTS and max(parts.values()) < 3 * 5000 / SALTS
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))
    folds = Counter(r["fold"] for r in B.stratified_folds(copies.drop("doc_id"), 5).collect())
    assert folds == dict.fromkeys(range(5), 1000)  # copies without a difference are one row until the end
