"""Results that stay whole: labels, confusion tables, folders and white space."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tongues.functions.text import digit_count, normalize_ws, word_count
from tongues.operators.evaluate import confusion_wide
from tongues.operators.ranking import key_cutoff
from tongues.operators.sampling import balance, stratified_split
from tongues.sources.scratch import shared_folder


def test_wide_confusion_loses_nothing(spark):
    pairs = spark.createDataFrame([("a", "a", 3), ("a", "b", 2), ("b", "a", 1), ("b", "c", 1)], "actual string, predicted string, n long")
    rows = {r["actual"]: r.asDict() for r in confusion_wide(pairs, ["a", "b", "c"]).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert sum(v for r in rows.values() for k, v in r.items() if k != "actual") == 7
    with pytest.raises(Exception, match="not listed"):
        confusion_wide(pairs, ["a", "b"]).collect()


def test_any_listed_label_and_no_other(spark):
    rows = spark.createDataFrame([(f"l{i % 6}", f"text {i}") for i in range(60)], "language string, text string")
    labels = [f"l{i}" for i in range(6)]
    split = stratified_split(rows, labels=labels)
    assert split.groupBy("language").agg({"is_test": "count"}).count() == 6 and split.filter("is_test").count() == 12
    assert balance(rows, 4, labels=labels).count() == 24
    with pytest.raises(Exception, match="not in the language dimension"):
        key_cutoff(rows, "language", "text", 42, F.lit(1), labels=labels[:5]).collect()


def test_shared_folder(spark):
    assert "scratch" in shared_folder(spark) or spark.conf.get("spark.checkpoint.dir", None)

    class Conf:
        @staticmethod
        def get(name, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session())


def test_collapsing_and_counting_edge_cases(spark):
    text = " a\u001cb   c\u0085　"
    row = spark.createDataFrame([(text, "1²①٣x"), (None, None), (" ", "")], "t string, d string").select(
        normalize_ws(F.col("t")).alias("t"), word_count(F.col("t")).alias("n"), digit_count(F.col("d")).alias("d")).collect()
    assert row[0].asDict() == {"t": "a b c", "n": 3, "d": 4}
    assert row[1].asDict() == {"t": None, "n": None, "d": None} and row[2].asDict() == {"t": "", "n": 0, "d": 0}
