"""Bounds of the work and memory of single tasks."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tongues.functions import grams as G
from tongues.functions import variants as V
from tongues.model import scoring
from tongues.model.vectors import BatchFeatures
from tongues.operators.augment import augment
from tongues.operators.sampling import balance, balance_distinct
from tongues.plans import queries


def sentences(spark, n):
    return spark.createDataFrame([("english", f"The sentence number {i} is here with the others.") for i in range(n)], "language string, text string")


def test_augment_deals_variants_out_to_as_many_tasks_as_asked(spark):
    rows = sentences(spark, 50)
    dealt = augment(rows, tasks=13)
    assert dealt.rdd.getNumPartitions() == 13
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, augment(rows).collect()))


def test_augment_moves_sentences_but_not_their_variants(spark):
    plan = augment(sentences(spark, 50), tasks=13)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.index("Exchange ") > plan.index("Generate ")  # the plan begins with its end


def test_variants_share_the_key_of_their_text(spark):
    odd = [c for c in map(chr, range(0x80, 0x20000)) if not 0xD800 <= ord(c) <= 0xDFFF and (c.lower() != c or c.upper() != c or c.isspace())]
    shapes = ("{} the and that with this have from {}!", "Note: tip:{}with x thıs this have?", "Th{}s has the th{}s and that {}.", "ΟΔΟΣ{} the ΣΑΣ {}Σ. fyi: and")
    texts = [shape.replace("{}", c) for shape in shapes for c in odd]
    df = spark.createDataFrame([("english", t) for t in texts], "language string, text string").withColumn("key", V.variant_key(F.col("text")))
    made = df.select("key", F.explode(V.variants(F.col("text"))).alias("variant"))
    assert made.filter(V.variant_key(F.col("variant")) != F.col("key")).isEmpty()
    assert df.select("key").distinct().count() > len(odd)
    few = df.select("language", "text").sample(0.05, 3).unionByName(spark.createDataFrame([
        (c, t) for c in ("english", None) for t in ("Note: the cat sat here.", "the cat sat here!", "teh cat sat here.", "THECAT SAT HERE?", "too short")
    ], "language string, text string"))
    assert sorted(map(tuple, augment(few, tasks=7).collect()), key=repr) == sorted(map(tuple, augment(few).collect()), key=repr)


def random_forest(rng, trees, features, deepest):
    """Trees with nodes in order from the root on, a leaf among them that is the whole tree."""
    nodes = []

    def grow(depth):
        at = len(nodes)
        nodes.append(None)
        if depth >= deepest or rng.random() < 0.2:
            nodes[at] = (-1, 0.0, 0, 0, [rng.random(), rng.random(), rng.random()])
        else:
            left = grow(depth + 1)
            nodes[at] = (rng.randrange(features), rng.choice([0.0, 0.25, 0.5, rng.random()]), left, grow(depth + 1), [0.0] * 3)
        return at

    roots = [grow(deepest if tree == 1 else 0) for tree in range(trees)]
    feature, threshold, left, right, share = map(np.array, zip(*nodes))
    return scoring.Forest(np.array(roots), feature, threshold, np.column_stack([left, right]).ravel(), share)


def test_forests_are_walked_together_as_they_are_one_by_one():
    rng = random.Random(8)
    forests = [random_forest(rng, trees, 12, deepest) for trees, deepest in ((7, 9), (7, 1), (4, 14))]
    rows = np.array([[rng.choice([0.0, 0.25, 0.5, rng.random()]) for _ in range(12)] for _ in range(150)])
    wanted = []
    for f in forests:
        votes = np.zeros((len(rows), 3))
        for r, row in enumerate(rows):
            for at in f.roots:
                while f.feature[at] >= 0:
                    at = f.child[2 * at + (row[f.feature[at]] > f.threshold[at])]
                votes[r] += f.share[at]
        wanted.append(votes / votes.sum(1, keepdims=True))
    found = [scoring.Forests(forests).probabilities(np.ascontiguousarray(rows[a:a + 64].T)) for a in range(0, 150, 64)]
    np.testing.assert_allclose(np.concatenate(found, 1), wanted, rtol=1e-12)
    for f, one in zip(forests, wanted):
        np.testing.assert_allclose(f.probabilities(rows), one, rtol=1e-12)
        assert f.probabilities(rows[:0]).shape == (0, 3)


def test_the_suite_is_scored_in_as_many_tasks_as_there_are_cores(spark, tmp_path):
    rows = [(i, f"The sentence number {i} is here with the others. It has the same end as all of them.", "en") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.suite(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 1)
    assert sorted(map(tuple, found.collect())) == sorted((t, lang) for lang, t in map(tuple, queries.corpus(spark, str(tmp_path)).collect()))
    assert found.count() == 41


def test_numbers_follow_the_terms_of_their_row():
    texts = ["the cat", None, "", "zz", "the the cat"]
    numbers = np.array([[1.0, 0.0], [0.0, 0.0], [2.0, 3.0], [0.0, 4.0], [5.0, 0.0]])
    batch = pa.RecordBatch.from_arrays([pa.array(texts), *map(pa.array, numbers.T.copy())], names=["text", "a", "b"])
    features = BatchFeatures([("the", 1.0), ("at", 2.0), ("zz", 1.5)], 2, 5, 2)
    ((start, stop, row, place, value),) = features.slices(batch, 0)
    assert (start, stop) == (0, 5) and sorted(zip(row, place)) == list(zip(row, place))
    dense = np.zeros((5, 5))
    dense[row, place] = value
    np.testing.assert_array_equal(dense[:, 3:], numbers)
    assert [list(np.flatnonzero(r)) for r in dense[:, :3]] == [[0, 1], [], [], [2], [0, 1]]


def test_remembered_grams_are_bounded_by_their_number(monkeypatch):
    monkeypatch.setattr(G, "GRAM_CACHE", 300)
    looked = []
    get = G.cached(lambda word: looked.append(word) or G.word_grams(word, 2, 5))
    words = ["a" * 40 + str(i) for i in range(20)]
    assert [get(w) for w in words] == [G.word_grams(w, 2, 5) for w in words]
    get(words[0])
    assert looked.count(words[0]) == 2  # its n-grams had to go


def test_texts_are_counted_in_small_parts(monkeypatch):
    texts = [None, "", *["some words " * 20_000] * 3, "x"]
    cuts = list(G.slices(texts))
    assert [stop for _, stop in cuts] == [start for start, _ in cuts[1:]] + [len(texts)]
    assert all(stop - start == 1 or sum(len(t or "") for t in texts[start:stop]) <= G.SLICE_CHARS for start, stop in cuts) and len(cuts) >= 3


def test_balanced_sample_reads_all_sentences_once(spark, monkeypatch):
    import tongues.operators.sampling as S

    rng = random.Random(5)
    rows = [(rng.choice(["english", "german"]), f"text {i % 9000}") for i in range(12_000)] + [("french", "few"), (None, "none")]
    df = spark.createDataFrame(rows, "language string, text string")
    writes = []
    monkeypatch.setattr(S, "stored", lambda rows, name: writes.append(kept := rows.localCheckpoint()) or kept)
    labels = ("english", "german", "french")
    found = balance_distinct(df, 30, labels=labels)
    wanted = balance(df.filter("language IS NOT NULL").distinct(), 30, labels=labels)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert len(writes) == 2 and [r["language"] for r in writes[1].collect()] == ["french"]  # only the small label is read again
