"""The trained detector: applying it, describing it, saving and loading it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.functions import report as R
from tongues.functions.text import strip, word_count
from tongues.model.forest import Sigmoid
from tongues.model.scoring import Forest, score_texts
from tongues.model.store import ModelStore
from tongues.model.vectors import feature_matrix
from tongues.sources.dims import FAMILIES, NAMES


@dataclass
class Detector:
    """A fitted vocabulary, a forest per calibration fold and their sigmoids."""

    terms: list[tuple[str, float]] = field(default_factory=list)  # in index order, with idf
    classes: list[str] = field(default_factory=list)
    forests: list[RandomForestClassificationModel] = field(default_factory=list)
    sigmoids: list[Sigmoid] = field(default_factory=list)
    names: dict[str, str] = field(default_factory=lambda: dict(NAMES))
    families: dict[str, str] = field(default_factory=lambda: dict(FAMILIES))
    min_n: int = 2
    max_n: int = 5
    nodes: list[Forest] = field(default_factory=list)  # of the forests, read when they are first needed

    @property
    def trained(self) -> bool:
        return bool(self.forests and self.classes)

    def features(self, df: DataFrame, text: str = "text") -> DataFrame:
        return feature_matrix(df, self.terms, text, "features", self.min_n, self.max_n)

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``probabilities`` in class order. Row-local: no shuffle, same in a stream."""
        if not self.trained:
            raise ValueError(R.ERROR_UNTRAINED)
        if len(self.nodes) != len(self.forests):
            self.nodes = [Forest.of(df.sparkSession, forest) for forest in self.forests]
        return score_texts(
            df, self.terms, self.nodes, self.sigmoids, len(self.classes), text, min_n=self.min_n, max_n=self.max_n
        )

    def detect(self, df: DataFrame, text: str = "text", top_n: int = 2) -> DataFrame:
        """Full result per row: label, confidence, alternatives, warnings or an error."""
        rows = df.withColumn(text, strip(F.col(text)))
        if not self.trained:
            blank = rows.withColumn("probabilities", F.lit(None).cast("array<double>"))
            return present(blank, ["-"], self.names, self.families, text, top_n, trained=False)
        return present(self.score(rows, text), self.classes, self.names, self.families, text, top_n)

    def detect_batch(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Label, confidence and a short preview; texts are judged as they are, unguarded."""
        best = R.top_predictions(F.col("probabilities"), self.classes, 1, self.names, self.families)
        others = [c for c in df.columns if c != text]
        return self.score(df, text).withColumn("_best", F.get(best, F.lit(0))).select(
            *others,
            R.text_preview(F.col(text), 50).alias("text"),
            F.col("_best.language").alias("language"),
            F.col("_best.confidence").alias("confidence"),
            F.col("_best.code").alias("language_code"),
        )

    def info(self, spark: SparkSession) -> DataFrame:
        """One row describing the model."""
        known = [code for code in self.names if code in self.classes]
        row = (
            [self.names[code] for code in known],
            known,
            sorted(set(self.families.values())),
            len(self.terms),
            "CalibratedRandomForest" if self.trained else "Not trained",
        )
        return spark.createDataFrame(
            [row],
            "languages array<string>, language_codes array<string>, language_families array<string>, "
            "features long, model_type string",
        )

    def save(self, spark: SparkSession, directory: str) -> bool:
        """Write a new version of the model below ``directory``; False when there is nothing to save.

        A version is a folder of its own and counts once its marker is there, which is written last. A save that breaks off leaves
        the earlier version in place, and readers of that one are not disturbed: it is deleted by the next save but one.
        """
        if not self.trained:
            return False
        store = ModelStore(spark, directory)
        path = store.begin()
        for fold, forest in enumerate(self.forests):
            forest.write().save(f"{path}/forests/{fold}")
        spark.createDataFrame(self.sigmoids, "fold int, class int, slope double, intercept double").coalesce(1).write.parquet(f"{path}/sigmoids")
        terms = [(i, term, weight) for i, (term, weight) in enumerate(self.terms)]
        spark.createDataFrame(terms, "term_index int, term string, idf double").coalesce(1).write.parquet(f"{path}/vocabulary")
        meta = {
            "classes": self.classes,
            "names": self.names,
            "families": self.families,
            "folds": len(self.forests),
            "min_n": self.min_n,
            "max_n": self.max_n,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/meta")
        store.commit(path)
        return True

    @classmethod
    def load(cls, spark: SparkSession, directory: str) -> Detector | None:
        """The last complete version in ``directory``, or None when there is none."""
        path = ModelStore(spark, directory).last()
        if path is None:
            return None
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        sigmoids = spark.read.parquet(f"{path}/sigmoids").orderBy("fold", "class").collect()
        terms = spark.read.parquet(f"{path}/vocabulary").orderBy("term_index").collect()
        folds = [f"{path}/forests/{fold}" for fold in range(meta["folds"])]
        return cls(
            terms=[(r["term"], r["idf"]) for r in terms],
            classes=meta["classes"],
            forests=[RandomForestClassificationModel.load(fold) for fold in folds],
            sigmoids=[tuple(r) for r in sigmoids],
            names=meta["names"],
            families=meta["families"],
            min_n=meta["min_n"],
            max_n=meta["max_n"],
            nodes=[Forest.read(spark, fold) for fold in folds],
        )


def present(
    df: DataFrame,
    classes: Sequence[str],
    names: dict[str, str] = NAMES,
    families: dict[str, str] = FAMILIES,
    text: str = "text",
    top_n: int = 2,
    trained: bool = True,
) -> DataFrame:
    """Detection columns from stripped ``text`` and ``probabilities``; all but ``error`` null on error."""
    others = [c for c in df.columns if c not in (text, "probabilities")]
    body = F.col(text)
    ranked = df.withColumn("error", R.detect_guard(body, trained)).withColumn(
        "_top", R.top_predictions(F.col("probabilities"), classes, max(top_n, 1), names, families)
    )
    first = F.get("_top", F.lit(0))
    shown = {
        "text": R.text_preview(body, 80),
        "language": first["language"],
        "language_code": first["code"],
        "confidence": first["confidence"],
        "confidence_level": R.confidence_level(first["confidence"]),
        "language_family": first["family"],
        "top_predictions": F.slice("_top", 1, top_n),
        "text_length": F.length(body).cast("long"),
        "word_count": word_count(body),
        "warning": R.short_warning(body),
        "note": R.mixed_note(F.slice("_top", 1, top_n)),
    }
    return ranked.select(
        *others, *[F.when(F.col("error").isNull(), value).alias(name) for name, value in shown.items()], "error"
    )
