from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array

from tongues.model.vectors import tfidf_vectors
from tongues.operators import ngrams as N

TEXTS = [
    "A bc DEF ghijklmnop", "the the cat", "a", "ab", "", "   ", "Straße straße ÉTÉ été",
    "x y z", "the " + "longword" * 120, "😀 ok 😀😀 a😀b",
]


def grams(text):
    out = Counter()
    for word in text.lower().split():
        w = f" {word} "
        for n in range(2, 6):
            for i in range(len(w) - n + 1):
                out[w[i : i + n]] += 1
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


def test_term_freq_equals_brute_force(docs):
    got = {(r["id"], r["term"]): r["tf"] for r in N.term_freq(docs, ["id"]).collect()}
    assert got == {(i, t): n for i, text in enumerate(TEXTS) for t, n in grams(text).items()}
    total = {r["term"]: r["occurrences"] for r in N.term_counts(docs).collect()}
    assert total == dict(sum((grams(t) for t in TEXTS), Counter()))


def test_term_freq_does_not_shuffle(docs):
    plan = N.term_freq(docs, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def plain_terms(max_features=30, min_df=2, max_df=0.9):
    df, cf = Counter(), Counter()
    for t in TEXTS:
        df.update(grams(t).keys())
        cf.update(grams(t))
    n = len(TEXTS)
    kept = [t for t in df if min_df <= df[t] <= max_df * n]
    best = sorted(kept, key=lambda t: (-cf[t], t.encode()))[:max_features]
    return {t: math.log((1 + n) / (1 + df[t])) + 1 for t in sorted(best, key=str.encode)}


def test_vocabulary_tfidf_and_vectors_agree(docs):
    postings = N.term_freq(docs, ["id"])
    terms = N.idf(N.vocabulary(N.doc_freq(postings), docs, 30), docs)
    rows = terms.orderBy("term_index").collect()
    expected = plain_terms()
    assert [r["term"] for r in rows] == list(expected)
    assert [r["idf"] for r in rows] == pytest.approx(list(expected.values()))

    got = {(r["id"], r["term_index"]): r["weight"] for r in N.tfidf(postings, terms, ["id"], 30).collect()}
    index = {t: i for i, t in enumerate(expected)}
    want = {}
    for i, text in enumerate(TEXTS):
        w = {index[t]: (1 + math.log(n)) * expected[t] for t, n in grams(text).items() if t in index}
        norm = math.sqrt(sum(v * v for v in w.values()))
        want.update({(i, j): v / norm for j, v in w.items()})
    assert got == pytest.approx(want)

    vectors = tfidf_vectors(docs, [(r["term"], r["idf"]) for r in rows])
    flat = {}
    for r in vectors.select("id", vector_to_array("tfidf").alias("v")).collect():
        flat.update({(r["id"], i): x for i, x in enumerate(r["v"]) if x})
    assert flat == pytest.approx(want)


def test_document_frequency_bounds(spark):
    # df 1 is dropped, exactly 0.9 n is kept, above it is dropped
    rows = [(i, "cc dd" if i < 9 else "cc") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, text string")
    kept = {r["term"] for r in N.vocabulary(N.doc_freq(N.term_freq(df, ["id"])), df).collect()}
    assert "dd" in kept and "cc" not in kept


def test_row_local_weights_equal_joined_ones(spark):
    texts = spark.createDataFrame([(1, "the cat the cats"), (2, "a dog"), (3, None), (4, ""), (5, "zzz")], "id long, text string")
    terms = spark.createDataFrame([("th", 0, 1.5), ("at", 1, 2.0), (" do", 2, 3.0)], "term string, term_index long, idf double")
    joined = {(r["id"], r["term_index"]): r["weight"] for r in N.tfidf(N.term_freq(texts, ["id"]), terms, ["id"], 3).collect()}
    rows = N.tfidf_rows(texts, [("th", 1.5), ("at", 2.0), (" do", 3.0)], ["id"])
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {(r["id"], r["term_index"]): round(r["weight"], 12) for r in rows.collect()} == {k: round(v, 12) for k, v in joined.items()}
    assert {i for i, _ in joined} == {1, 2}
