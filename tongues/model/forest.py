"""Class-balanced random forest with cross-validated sigmoid calibration."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.config import TrainConfig
from tongues.operators.sampling import class_weights
from tongues.sources.scratch import cut_lineage

Sigmoid = tuple[int, int, float, float]  # fold, class index, slope, intercept


def in_parallel(spark, jobs, threads: int) -> list:
    """Run independent fits from driver threads; Spark schedules their jobs together."""
    with ThreadPool(max(1, min(threads, len(jobs)))) as pool:
        started = [pool.apply_async(inheritable_thread_target(spark)(job)) for job in jobs]
        return [result.get() for result in started]


def train_forest(
    rows: DataFrame,
    classes: Sequence[str],
    config: TrainConfig = TrainConfig(),
    label: str = "language",
    features: str = "features",
) -> RandomForestClassificationModel:
    """Fit on ``(label, features)``; class weights balance the labels of these rows."""
    position = F.array_position(F.lit(list(classes)), F.col(label))
    indexed = class_weights(rows, label, classes).select(
        features, "weight", (position - 1).cast("double").alias("_y")
    )
    return RandomForestClassifier(
        featuresCol=features,
        labelCol="_y",
        weightCol="weight",
        predictionCol="",
        rawPredictionCol="",
        probabilityCol="_p",
        numTrees=config.trees,
        maxDepth=config.max_depth,
        minInstancesPerNode=config.min_leaf,
        featureSubsetStrategy="sqrt",
        seed=config.seed,
    ).fit(indexed)


def _class_columns(classes: Sequence[str]) -> list[int]:
    """Classes that get a sigmoid: all of them, or only the second of two."""
    return [1] if len(classes) == 2 else list(range(len(classes)))


def fit_sigmoids(
    scored: DataFrame, classes: Sequence[str], folds: int, label: str = "language", score: str = "_score"
) -> list[Sigmoid]:
    """One-vs-rest sigmoids of held-out scores, for every fold and class in one regression.

    Targets are smoothed by the class counts: (n+ + 1) / (n+ + 2) for members and
    1 / (n- + 2) for the rest; a binomial regression takes such targets as they are.
    Each (fold, class) has its own slope and intercept column, zero elsewhere, so the
    joint fit equals separate ones. ``scored`` is ``(fold, label, score array)``.
    """
    counts = {(r["fold"], r[label]): r["n"] for r in scored.groupBy("fold", label).agg(F.count("*").alias("n")).collect()}
    groups = [(fold, k) for fold in range(folds) for k in _class_columns(classes)]
    high, low = [], []
    for fold, k in groups:
        total = sum(n for (f, _), n in counts.items() if f == fold)
        member = counts.get((fold, classes[k]), 0)
        high.append((member + 1) / (member + 2))
        low.append(1 / (total - member + 2))

    each = F.explode(F.lit(_class_columns(classes))).alias("_k")
    per_fold = len(groups) // folds
    first = groups[0][1]
    rows = scored.select("fold", label, score, each).select(
        (F.col("fold") * per_fold + F.col("_k") - first).cast("int").alias("_g"),
        F.get(score, F.col("_k")).alias("_s"),
        (F.col(label) == F.get(F.lit(list(classes)), F.col("_k"))).alias("_member"),
    )
    target = F.when(F.col("_member"), F.get(F.lit(high), F.col("_g"))).otherwise(F.get(F.lit(low), F.col("_g")))
    zero, one = F.lit(0.0), F.lit(1.0)
    slots = F.sequence(F.lit(0), F.lit(len(groups) - 1))
    design = F.concat(
        F.transform(slots, lambda i: F.when(i == F.col("_g"), F.col("_s")).otherwise(zero)),
        F.transform(slots, lambda i: F.when(i == F.col("_g"), one).otherwise(zero)),
    )
    data = rows.select(array_to_vector(design).alias("_x"), target.alias("_t"))
    # The union of folds has folds times the partitions of one; every iteration is a job over them.
    data = data.coalesce(max(1, scored.rdd.getNumPartitions() // folds)).cache()
    try:
        fitted = GeneralizedLinearRegression(
            family="binomial", link="logit", featuresCol="_x", labelCol="_t",
            fitIntercept=False, regParam=0.0, tol=1e-10, maxIter=100,
        ).fit(data)
    finally:
        data.unpersist()
    found = [float(c) for c in fitted.coefficients]
    return [(fold, k, found[g], found[len(groups) + g]) for g, (fold, k) in enumerate(groups)]


def calibrate(
    rows: DataFrame,
    classes: Sequence[str],
    config: TrainConfig = TrainConfig(),
    label: str = "language",
) -> tuple[list[RandomForestClassificationModel], list[Sigmoid]]:
    """A forest per fold, trained on the other folds, and sigmoids from the held-out folds.

    ``rows`` has ``(label, features, fold)`` and should be stored: it is read once per
    fit. The forests are independent and fitted side by side.
    """
    spark = rows.sparkSession

    def fit(fold: int):
        return train_forest(rows.filter(F.col("fold") != fold), classes, config, label)

    forests = in_parallel(spark, [lambda f=f: fit(f) for f in range(config.folds)], config.parallelism)
    held = [
        forest.transform(rows.filter(F.col("fold") == fold)).select("fold", label, vector_to_array("_p").alias("_score"))
        for fold, forest in enumerate(forests)
    ]
    scored = cut_lineage(reduce(DataFrame.unionAll, held))
    return forests, fit_sigmoids(scored, classes, config.folds, label)


def calibrated_probabilities(
    df: DataFrame,
    forests: Sequence[RandomForestClassificationModel],
    sigmoids: Sequence[Sigmoid],
    classes: Sequence[str],
    output: str = "probabilities",
) -> DataFrame:
    """Mean over folds of the normalised sigmoid outputs, in class order. Row-local."""
    k = len(classes)
    lines = {(fold, cls): (slope, intercept) for fold, cls, slope, intercept in sigmoids}
    columns = df.columns
    members = []
    for fold, forest in enumerate(forests):
        raw, member = f"_p{fold}", f"_c{fold}"
        df = forest.setProbabilityCol(raw).transform(df).withColumn(raw, vector_to_array(raw))

        def sigmoid(c: int, fold=fold, raw=raw):
            slope, intercept = lines[fold, c]
            return 1 / (1 + F.exp(-(F.get(raw, F.lit(c)) * slope + intercept)))

        if k == 2:
            df = df.withColumn(member, sigmoid(1)).withColumn(member, F.array(1 - F.col(member), F.col(member)))
        else:
            df = df.withColumn(member, F.array(*[sigmoid(c) for c in range(k)]))
            total = sum((F.get(member, F.lit(c)) for c in range(1, k)), F.get(member, F.lit(0)))
            df = df.withColumn("_sum", total).withColumn(
                member,
                F.when(F.col("_sum") > 0, F.transform(member, lambda p: p / F.col("_sum"))).otherwise(
                    F.lit([1.0 / k] * k)
                ),
            )
        members.append(member)

    def mean(c: int):
        total = F.get(members[0], F.lit(c))
        for member in members[1:]:
            total = total + F.get(member, F.lit(c))
        return total / len(members)

    return df.withColumn(output, F.array(*[mean(c) for c in range(k)])).select(*columns, output)
