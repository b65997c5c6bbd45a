"""The stored corpus of known sentences, and the capped corpus that grows with a stream."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tongues.operators.sets import capped_corpus, new_sentences
from tongues.sources.known import KnownCorpus
from tongues.streaming.corpora import CappedCorpus

S = "language string, text string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(leaf, text):
    """Lines of the plan from ``leaf`` up to the join that it feeds."""
    lines = [(re.search(r"[A-Z]", line).start(), line) for line in text.splitlines() if re.search(r"[A-Z]", line)]
    at = next(i for i, (_, line) in enumerate(lines) if leaf in line)
    found = [lines[at][1]]
    while "Join" not in found[-1]:
        at = next(i for i in range(at - 1, -1, -1) if lines[i][0] < lines[at][0])
        found.append(lines[at][1])
    return found


@pytest.mark.parametrize("on", [("language", "text"), ("text",)])
def test_known_side_is_not_exchanged(spark, tmp_path, on):
    rng = random.Random(3)

    def some(n):
        return spark.createDataFrame([(rng.choice("ab"), f"text {rng.randint(0, 300)}") for _ in range(n)], S)

    known = KnownCorpus(spark, str(tmp_path / "known"), 5, on)
    assert known.read().count() == 0
    first, second, third = some(200), some(200), some(400)
    known.add(first)
    assert known.files() <= 5
    wanted = sorted(new_sentences(second, first, on).collect())
    assert sorted(known.unknown(second).collect()) == wanted and wanted
    known.add(second)
    both = first.union(second)
    seen = {r["text"] if len(on) == 1 else tuple(r) for r in both.collect()}
    assert {r["text"] if len(on) == 1 else tuple(r) for r in known.read().collect()} == seen
    again = KnownCorpus(spark, str(tmp_path / "known"), 5, on)  # as another session would
    wanted = sorted(new_sentences(third, both, on).collect())
    assert sorted(again.unknown(third).collect()) == wanted
    text = plan(again.unknown(third))
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert above("FileScan parquet", text) and not any("Exchange" in line for line in above("FileScan parquet", text))
    small = known.compact()
    assert small.files() <= 5 and sorted(small.read().collect()) == sorted(known.read().collect())
    for k in (known, again, small):
        k.close()


def pages(rng, n):
    rows = []
    for order in range(n):
        for _ in range(rng.randint(0, 6)):
            rows.append((rng.choice(["english", "german", "french"]), order, f"sentence {rng.randint(0, 60)}"))
    return rows


@pytest.mark.parametrize("cap", [1, 7, 20, 1000])
def test_capped_stream_equals_batch(spark, tmp_path, cap):
    rng = random.Random(cap)
    rows = pages(rng, 60)
    schema = "language string, page_order long, text string"
    wanted = sorted(capped_corpus(spark.createDataFrame(rows, schema), cap).collect())
    corpus = CappedCorpus(spark, str(tmp_path / "corpus"), cap)
    assert corpus.read().count() == 0
    cuts = [0, *sorted(rng.sample(range(1, 60), 3)), 60]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        some = spark.createDataFrame([r for r in rows if a <= r[1] < b], schema)
        corpus.absorb(some, batch)
        if batch == 1:
            corpus.absorb(some, batch)  # run again after a failure
    assert sorted(corpus.read().collect()) == wanted


def test_capped_stream_over_restarts(spark, tmp_path):
    rows = pages(random.Random(1), 40)
    schema = "language string, page_order long, text string"
    all_ = spark.createDataFrame(rows, schema)
    source = str(tmp_path / "in")
    for low, high in ((0, 15), (15, 16), (16, 40)):
        all_.filter(F.col("page_order").between(low, high - 1)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        CappedCorpus(spark, str(tmp_path / "corpus"), 10).start(stream, str(tmp_path / "checkpoint"))
    assert sorted(CappedCorpus(spark, str(tmp_path / "corpus")).read().collect()) == sorted(capped_corpus(all_, 10).collect())
