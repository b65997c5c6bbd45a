"""Training a detector from labelled examples and scoring it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.config import TrainConfig
from tongues.functions.stats import ALL
from tongues.model.detector import Detector
from tongues.model.forest import calibrate
from tongues.operators import evaluate as E
from tongues.operators import ngrams as N
from tongues.operators.sampling import balance_distinct, split_summary, stratified_folds, stratified_split
from tongues.sources.dims import CODES
from tongues.sources.scratch import cut_lineage


@dataclass
class Training:
    """A detector with the reports of its held-out rows (``language``, ``predicted``)."""

    detector: Detector
    predictions: DataFrame
    summary: DataFrame

    @property
    def pairs(self) -> DataFrame:
        return E.pair_counts(self.predictions)

    def accuracy(self) -> DataFrame:
        return E.accuracy(self.pairs)

    def report(self) -> DataFrame:
        return E.class_report(self.pairs)

    def confusion(self) -> DataFrame:
        return E.confusion_matrix(self.pairs)


def fit_terms(texts: DataFrame, config: TrainConfig = TrainConfig()) -> list[tuple[str, float]]:
    """The vocabulary with its idf, in index order: at most ``max_features`` rows reach the driver."""
    found = N.text_frequencies(texts, "text", config.min_n, config.max_n)
    chosen = N.vocabulary(found, texts, config.max_features, config.min_df, config.max_df)
    rows = N.idf(chosen, texts).select("term", "idf").orderBy("term_index").collect()
    if not rows:
        raise ValueError("no term occurs often enough to train on")
    return [(r["term"], r["idf"]) for r in rows]


def _partitions(n: int, cores: int) -> int:
    """Few tasks for few rows, as fitting runs many short jobs; all cores and more for many rows."""
    return min(max(1, n // 500), max(cores, n // 50_000))


def train_model(examples: DataFrame, config: TrainConfig = TrainConfig(), labels=CODES) -> Training:
    """Balance, split, fit the vocabulary, then a calibrated forest on the training rows.

    ``examples`` is ``(language, text)``.
    """
    spark = examples.sparkSession
    if config.max_per_class is None:
        rows = examples.select("language", "text").distinct()
    else:
        rows = balance_distinct(examples, config.max_per_class, seed=config.seed, labels=labels)
    rows = cut_lineage(rows)
    parts = _partitions(rows.count(), spark.sparkContext.defaultParallelism)
    rows = stratified_split(rows, config.test_size, seed=config.seed, labels=labels)
    rows = cut_lineage(rows.repartition(parts, "text"))
    classes = [r["language"] for r in rows.select("language").distinct().orderBy("language").collect()]
    if len(classes) < 2:
        raise ValueError("training needs at least two languages")
    train = rows.filter(~F.col("is_test"))
    terms = fit_terms(rows if config.fit_on == "all" else train, config)
    detector = Detector(terms=terms, classes=classes, min_n=config.min_n, max_n=config.max_n)

    folded = detector.features(stratified_folds(train, config.folds, seed=config.seed))
    folded = cut_lineage(
        folded.repartition(parts, "text").sortWithinPartitions("text").select("language", "features", "fold")
    )
    detector.forests, detector.sigmoids = calibrate(folded, classes, config)

    held = detector.detect_batch(rows.filter("is_test").withColumnRenamed("language", "expected"))
    predictions = held.select(F.col("expected").alias("language"), F.col("language_code").alias("predicted"))
    return Training(detector, predictions, split_summary(rows, len(terms) + len(ALL)))


def suite_eval(detector: Detector, suite: DataFrame, top_n: int = 2) -> DataFrame:
    """Score ``(text, expected)``: prediction, whether it is right, and the other candidates if not."""
    found = detector.detect(suite.withColumn("original", F.col("text")), top_n=top_n)
    correct = F.coalesce(F.col("language_code") == F.col("expected"), F.lit(False))
    alternatives = F.when(~correct, F.slice("top_predictions", 2, max(top_n - 1, 1)))
    return found.select(
        F.col("original").alias("text"), "expected", "language", "language_code", "confidence",
        correct.alias("correct"), alternatives.alias("alternatives"), "error",
    )


def suite_score(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        F.count("*").alias("total"), F.count_if("correct").alias("correct")
    ).withColumn("accuracy", F.coalesce(F.try_divide(F.col("correct") * 100.0, F.col("total")), F.lit(0.0)))
