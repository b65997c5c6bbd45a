"""The most used n-grams through bounded summaries, against counting all of them."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tongues.operators import frequent as Q
from tongues.operators.ngrams import text_frequencies, vocabulary


def corpus(spark, n=400):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(500)]
    texts = [" ".join(rng.choice(words[: rng.choice([5, 50, 500])]) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return spark.createDataFrame([(t,) for t in [None, "", *texts]], "text string").repartition(5)


@pytest.mark.parametrize(("size", "survivors", "features", "counts_all"), [
    (1 << 16, 1 << 16, 100, 0),   # nothing is lost
    (1500, 1 << 16, 40, 0),       # summaries lose uses, the threshold is above them
    (20, 1 << 16, 40, 1),         # summaries too small to tell: all are counted
    (1 << 16, 10, 40, 1),         # too many survivors
    (1 << 16, 1 << 16, 10**6, 0),  # fewer terms than wanted
])
def test_frequent_terms_equal_all_counts(spark, monkeypatch, size, survivors, features, counts_all):
    monkeypatch.setattr(Q, "WORDS", 40)
    calls = []
    monkeypatch.setattr(Q, "text_frequencies", lambda *a: calls.append(1) or text_frequencies(*a))
    df = corpus(spark)
    found = Q.frequent_terms(df, max_features=features, max_df=0.5, size=size, survivors=survivors)
    wanted = vocabulary(text_frequencies(df), df, features, 2, 0.5)
    assert sorted(found.collect()) == sorted(wanted.collect()) and found.count() == min(features, wanted.count())
    assert len(calls) == counts_all


def test_threshold_is_lowered_past_terms_that_do_not_qualify(spark):
    often = " ".join(f"x{i:02d}" for i in range(60))
    rows = [(f"{often} {often} rare{i % 7} rare{i % 7}",) for i in range(50)]
    df = spark.createDataFrame(rows, "text string")
    found = Q.frequent_terms(df, max_features=5, max_df=0.9)
    assert sorted(found.collect()) == sorted(vocabulary(text_frequencies(df), df, 5, 2, 0.9).collect()) and found.count() == 5


def test_no_texts(spark):
    assert Q.frequent_terms(spark.createDataFrame([], "text string")).count() == 0


def test_summaries_bound_what_they_lose():
    rng = random.Random(5)
    true, merged, lost = Counter(), Counter(), 0
    for _ in range(4):
        summary = Q.Summary(50)
        for _ in range(60):
            some = Counter(f"t{int(rng.paretovariate(0.7))}" for _ in range(100))
            true.update(some)
            summary.add(some)
        summary.cut()
        assert len(summary.uses) <= 50
        merged.update(summary.uses)
        lost += summary.lost
    assert 0 < lost < sum(true.values()) / 50
    assert all(merged[t] <= n <= merged[t] + lost for t, n in true.items())
