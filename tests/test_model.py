from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tongues.config import TrainConfig
from tongues.functions import report as R
from tongues.functions.grams import word_grams
from tongues.model.detector import Detector, present
from tongues.model.forest import fit_sigmoids
from tongues.model.store import ModelStore
from tongues.operators.augment import augment
from tongues.operators.sampling import stratified_split
from tongues.plans.training import suite_eval, suite_score, train_model
from tongues.sources.corpus import read_seed
from tongues.streaming.jobs import run_available, stream_detect

SUITE = [
    ("The boat left the quiet harbour before the sun came up.", "english"),
    ("We should buy new chairs for the kitchen this week.", "english"),
    ("The teacher said that the lesson was too long.", "english"),
    ("Das Boot verließ den ruhigen Hafen, bevor die Sonne aufging.", "german"),
    ("Wir sollten diese Woche neue Stühle für die Küche kaufen.", "german"),
    ("Der Lehrer sagte, dass die Stunde zu lang war.", "german"),
    ("El barco salió del puerto tranquilo antes de que saliera el sol.", "spanish"),
    ("Esta semana tenemos que comprar sillas nuevas para la cocina.", "spanish"),
    ("El profesor dijo que la clase era demasiado larga.", "spanish"),
    ("Le bateau a quitté le port tranquille avant le lever du soleil.", "french"),
    ("Nous devons acheter de nouvelles chaises pour la cuisine cette semaine.", "french"),
    ("Le professeur a dit que la leçon était trop longue.", "french"),
    ("La barca ha lasciato il porto tranquillo prima del sorgere del sole.", "italian"),
    ("Questa settimana dobbiamo comprare delle sedie nuove per la cucina.", "italian"),
    ("Il maestro ha detto che la lezione era troppo lunga.", "italian"),
]


@pytest.fixture(scope="module")
def training(spark):
    config = TrainConfig(trees=15, max_depth=10, max_per_class=120, folds=3, max_features=600)
    return train_model(augment(read_seed(spark)).select("language", "text"), config)


def test_training_reports(training):
    summary = training.summary.first()
    assert (summary["train_rows"], summary["test_rows"], summary["labels"]) == (480, 120, 5)
    assert training.accuracy().first()["accuracy"] >= 0.95
    labels = [r["label"] for r in training.report().collect()]
    assert set(labels) >= {"english", "italian", "accuracy", "macro avg", "weighted avg"}
    assert training.confusion().count() == 25


def test_detect_suite(spark, training):
    suite = spark.createDataFrame(SUITE, "text string, expected string")
    evaluated = suite_eval(training.detector, suite).cache()
    score = suite_score(evaluated).first()
    assert score["total"] == 15 and score["accuracy"] >= 80
    for r in evaluated.collect():
        assert r["error"] is None and (r["alternatives"] is None) == r["correct"]


def test_detect_fields_and_guards(spark, training):
    texts = ["", "   ", "ab", " abc ", "The same words as the others here.", None, "x" * 81, "Guten Tag"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = {r["id"]: r for r in training.detector.detect(df, top_n=3).collect()}
    assert [rows[i]["error"] for i in range(8)] == [
        R.ERROR_EMPTY, R.ERROR_EMPTY, R.ERROR_SHORT, None, None, R.ERROR_EMPTY, None, None,
    ]
    assert rows[0]["language"] is None and rows[3]["text"] == "abc" and rows[3]["text_length"] == 3
    english = rows[4]
    assert english["language_code"] == "english" and english["language"] == "English"
    assert english["language_family"] == "Germanic" and english["word_count"] == 7
    assert len(english["top_predictions"]) == 3
    assert english["confidence"] == english["top_predictions"][0]["confidence"]
    assert rows[6]["text"] == "x" * 80 + "..." and rows[3]["warning"] == R.WARN_VERY_SHORT
    assert rows[7]["warning"] == R.WARN_VERY_SHORT
    scored = training.detector.score(df.na.fill("")).collect()
    assert all(math.isclose(sum(r["probabilities"]), 1, rel_tol=1e-9) for r in scored)


def test_untrained(spark):
    df = spark.createDataFrame([("some text",)], "text string")
    assert Detector().detect(df).first()["error"] == R.ERROR_UNTRAINED
    with pytest.raises(ValueError):
        Detector().detect_batch(df)
    assert Detector().info(spark).first()["model_type"] == "Not trained"


def test_save_and_load(spark, training, tmp_path):
    assert Detector.load(spark, str(tmp_path / "none")) is None
    assert Detector().save(spark, str(tmp_path / "empty")) is False
    assert training.detector.save(spark, str(tmp_path / "model")) is True
    loaded = Detector.load(spark, str(tmp_path / "model"))
    suite = spark.createDataFrame(SUITE, "text string, expected string")
    before = sorted(map(tuple, training.detector.detect_batch(suite).collect()))
    assert sorted(map(tuple, loaded.detect_batch(suite).collect())) == before
    info = loaded.info(spark).first()
    assert info["languages"] == ["English", "German", "Spanish", "French", "Italian"]
    assert info["features"] == len(training.detector.terms) and info["language_families"] == ["Germanic", "Romance"]
    assert training.detector.detect_batch(suite.limit(0)).count() == 0


def test_stream_equals_batch(spark, training, tmp_path):
    texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SUITE)], "id int, text string")
    source = str(tmp_path / "in")
    texts.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(texts.schema).parquet(source)
    run_available(stream_detect(stream, training.detector), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(str, training.detector.detect(texts).collect()))


def newton(score, target):
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * score + b)))
        g = np.array([((p - target) * score).sum(), (p - target).sum()])
        w = p * (1 - p)
        h = np.array([[(w * score**2).sum(), (w * score).sum()], [(w * score).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return a, b


@pytest.mark.parametrize("classes", [("a", "b", "c"), ("a", "b")])
def test_joint_sigmoids_equal_separate_fits(spark, classes):
    rng = np.random.default_rng(7)
    rows = []
    for fold in range(2):
        for i in range(90):
            label = classes[i % len(classes)]
            raw = rng.random(len(classes)) + 0.8 * np.array([c == label for c in classes])
            rows.append((fold, label, [float(x) for x in raw / raw.sum()]))
    df = spark.createDataFrame(rows, "fold long, language string, _score array<double>")
    for fold, k, slope, intercept in fit_sigmoids(df, classes, 2):
        score = np.array([r[2][k] for r in rows if r[0] == fold])
        member = np.array([r[1] == classes[k] for r in rows if r[0] == fold])
        n = member.sum()
        target = np.where(member, (n + 1) / (n + 2), 1 / (len(member) - n + 2))
        assert (slope, intercept) == pytest.approx(newton(score, target), rel=1e-5)


def test_report_edges(spark):
    values = [95.0, 95.1, 85.0, 85.1, 75.0, 75.5, 60.0, 61.0, 40.0, 40.5, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    assert [r[0] for r in df.select(R.confidence_level(F.col("c"))).collect()] == [
        "Very High", "Excellent", "High", "Very High", "Medium", "High", "Low", "Medium", "Very Low", "Low", "Very Low",
    ]
    sizes = [9, 10, 24, 25, 50, 51]
    df = spark.createDataFrame([("x" * n,) for n in sizes], "t string")
    rows = df.select(R.short_warning(F.col("t")), R.text_preview(F.col("t"), 50)).collect()
    assert [r[0] for r in rows] == [R.WARN_VERY_SHORT, R.WARN_SHORT, R.WARN_SHORT, None, None, None]
    assert [len(r[1]) for r in rows] == [9, 10, 24, 25, 50, 53]


def test_ties_notes_and_unknown_codes(spark):
    rows = [(1, "text one", [0.4, 0.4, 0.2]), (2, "text two", [0.5, 0.35, 0.15]), (3, "text three", [0.5, 0.36, 0.14])]
    df = spark.createDataFrame(rows, "id int, text string, probabilities array<double>")
    out = {r["id"]: r for r in present(df, ["zz", "english", "german"]).collect()}
    assert out[1]["language_code"] == "english" and out[2]["language"] == "zz" and out[2]["language_family"] == "Unknown"
    assert out[1]["note"] and out[2]["note"] is None and out[3]["note"]
    single = present(df, ["zz", "english", "german"], top_n=1).first()
    assert single["note"] is None and len(single["top_predictions"]) == 1


def test_an_interrupted_save_leaves_the_model_before_it(spark, training, tmp_path, monkeypatch):
    home = str(tmp_path / "model")
    store = ModelStore(spark, home)
    assert training.detector.save(spark, home)
    first = store.last()
    other = Detector(**{**vars(training.detector), "terms": [(t, 1.0) for t, _ in training.detector.terms]})
    monkeypatch.setattr(ModelStore, "commit", lambda self, path: (_ for _ in ()).throw(OSError("broken off")))
    with pytest.raises(OSError):
        other.save(spark, home)
    monkeypatch.undo()
    assert store.last() == first and len(store.versions(complete=False)) == 2
    assert Detector.load(spark, home).terms == training.detector.terms
    assert other.save(spark, home)
    assert Detector.load(spark, home).terms == other.terms
    assert store.versions() == [first, store.last()]  # whoever reads the first one still can
    assert training.detector.save(spark, home)
    assert first not in store.versions(complete=False) and len(store.versions(complete=False)) == 2
    assert Detector.load(spark, home).terms == training.detector.terms


def test_fitting_the_vocabulary_on_training_rows_only(spark):
    """With ``fit_on="train"`` nothing of the test rows reaches the features: a word that only they have is no term."""
    seed = read_seed(spark).select("language", "text")
    config = TrainConfig(trees=5, max_depth=6, folds=2, max_features=10**6, min_df=1, max_df=1.0, max_per_class=None)
    tests = stratified_split(seed, config.test_size, seed=config.seed)
    marked = tests.select("language", F.when(F.col("is_test"), F.concat("text", F.lit(" qqqxq"))).otherwise(F.col("text")).alias("text"), "is_test")
    pairs = {r["text"]: r["is_test"] for r in marked.collect()}
    found = {}
    for fit_on in ("all", "train"):
        model = train_model(marked.select("language", "text"), replace(config, fit_on=fit_on))
        found[fit_on] = {t for t, _ in model.detector.terms}
        assert model.summary.first()["features"] == len(found[fit_on]) + 18
    assert found["train"] < found["all"]
    # the split goes by text, so the marked texts are dealt out anew; a gram of theirs is a term only if one was trained on
    held = {t for t, is_test in pairs.items() if is_test}
    split = stratified_split(marked.select("language", "text"), config.test_size, seed=config.seed)
    trained_on = {r["text"] for r in split.filter("NOT is_test").collect()}
    grams = {g for t in trained_on for w in t.lower().split() for g in word_grams(w, 2, 5)}
    assert found["train"] == grams and ("qxq " in grams) == any(t in trained_on for t in held)
