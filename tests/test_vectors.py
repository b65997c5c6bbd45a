"""Vectors that are built column by column, against counting text by text."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tongues.config import TrainConfig
from tongues.functions import grams as G
from tongues.functions import stats
from tongues.model import vectors as V
from tongues.model.detector import Detector
from tongues.model.forest import calibrated_probabilities, train_forest

rng = random.Random(12)
WORDS = ["the", "The", "aaa", "aaaa", "ünï", "z", "x" * 80, "of", "and", "anda"]
TEXTS = [None, "", "  \n", "zzz qqq", "the the the", "x" * 80 + " " + "x" * 80] + [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 30))) for _ in range(200)]
TERMS = sorted({g for w in WORDS[:8] for g in G.word_grams(w.lower(), 2, 5)} - {"he", " a"})
VOCABULARY = [(t, 1.0 + 0.1 * i) for i, t in enumerate(TERMS)]


def plain(text):
    index = {t: i for i, t in enumerate(TERMS)}
    counts = G.count_grams(text, lambda w: [index[g] for g in G.word_grams(w, 2, 5) if g in index])
    raw = {i: (1.0 + math.log(n)) * VOCABULARY[i][1] for i, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
    return {i: w / norm for i, w in raw.items()}


@pytest.mark.parametrize("cache", [G.WORD_CACHE, 7])
def test_terms_are_counted_as_text_by_text(monkeypatch, cache):
    monkeypatch.setattr(G, "WORD_CACHE", cache)  # 7: texts are cut into pieces and the memory is emptied all the time
    counter = G.TermCounter(TERMS, 2, 5)
    index = {t: i for i, t in enumerate(TERMS)}
    for texts in (TEXTS, TEXTS[:3], [], TEXTS[::-1]):
        row, term, uses = counter.count(texts)
        found = [{} for _ in texts]
        for r, t, n in zip(row.tolist(), term.tolist(), uses.tolist()):
            found[r][t] = n
        assert found == [G.count_grams(t, lambda w: [index[g] for g in G.word_grams(w, 2, 5) if g in index]) for t in texts]
        assert sorted(zip(row, term)) == list(zip(row, term))


@pytest.mark.parametrize("slice_texts", [V.SLICE_TEXTS, 3])
def test_vectors_equal_plain_weights(spark, monkeypatch, slice_texts):
    monkeypatch.setattr(V, "SLICE_TEXTS", slice_texts)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    for r in V.tfidf_vectors(df, VOCABULARY).collect():
        wanted = plain(r["text"])
        assert r["tfidf"].size == len(TERMS) and list(r["tfidf"].indices) == sorted(wanted)
        assert all(abs(r["tfidf"][i] - w) < 1e-12 for i, w in wanted.items())


def test_matrix_equals_assembled_parts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    parts = V.feature_vectors(V.tfidf_vectors(df, VOCABULARY, output="a"), output="b")
    parts = VectorAssembler(inputCols=["a", "b"], outputCol="both").transform(parts).select("id", "both")
    rows = V.feature_matrix(df, VOCABULARY).join(parts, "id").collect()
    assert len(rows) == len(TEXTS)
    assert all(abs(r["features"].toArray() - r["both"].toArray()).max() < 1e-12 for r in rows)
    assert rows[0]["features"].size == len(TERMS) + len(stats.ALL)


def test_no_vocabulary_and_other_columns(spark):
    df = spark.createDataFrame([("a b", 1, [1, 2], None)], "text string, features int, other array<int>, gone string")
    found = V.feature_matrix(df, [])
    assert found.columns == ["text", "other", "gone", "features"]
    assert found.first()["features"].size == len(stats.ALL)


def test_no_row_function_in_a_scoring_plan(spark):
    detector = Detector(terms=VOCABULARY)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    plan = detector.features(df).filter(F.col("id") > 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan


@pytest.mark.parametrize("labels", [("a", "b"), ("a", "b", "c")])
def test_scores_equal_those_of_the_library(spark, labels):
    config = TrainConfig(trees=9, max_depth=6, folds=2)
    words = {"a": ["the", "of", "and"], "b": ["aaa", "aaaa", "z"], "c": ["ünï", "anda", "of"]}
    rows = [(labels[i % len(labels)], i // len(labels) % 2, " ".join(rng.choice([*words[labels[i % len(labels)]], *WORDS]) for _ in range(rng.randint(1, 9)))) for i in range(150)]
    df = spark.createDataFrame(rows, "language string, fold long, text string")
    features = V.feature_matrix(df, VOCABULARY).cache()
    forests = [train_forest(features.filter(F.col("fold") != fold), labels, config) for fold in range(2)]
    sigmoids = [(fold, k, 3.0 + fold, -1.0 - k) for fold in range(2) for k in range(len(labels))]
    more = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    wanted = {r["id"]: r["probabilities"] for r in calibrated_probabilities(V.feature_matrix(more, VOCABULARY), forests, sigmoids, labels).collect()}
    detector = Detector(terms=VOCABULARY, classes=list(labels), forests=forests, sigmoids=sigmoids)
    found = detector.score(more)
    assert found.columns == ["id", "text", "probabilities"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan and "UDF" not in plan
    got = {r["id"]: r["probabilities"] for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert all(got[i] == pytest.approx(wanted[i], abs=1e-12) for i in wanted)
