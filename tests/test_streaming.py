from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tongues.operators.paragraphs import page_sentences
from tongues.operators.sentences import clean_sentences, document_sentences
from tongues.operators.sets import distinct_sentences
from tongues.sources import dims
from tongues.streaming.corpora import PageCorpus
from tongues.streaming.jobs import run_available, stream_new_sentences


@pytest.mark.parametrize("timed", [False, True])
def test_new_sentences_over_several_runs(spark, tmp_path, timed):
    texts = ["This sentence is long enough to keep. Another one that is kept as well.", "Short.",
             "This sentence is long enough to keep. A third and different one follows."]
    docs = spark.createDataFrame(
        [(i, "english", texts[i % 3]) for i in range(30)], "doc_id long, language string, text string"
    ).withColumn("at", F.timestamp_seconds(F.col("doc_id")))
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (docs.filter("doc_id < 10"), docs.filter("doc_id >= 10")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(docs.schema).parquet(source)
        run_available(stream_new_sentences(stream, ingest_time="at" if timed else None), out, checkpoint)
    got = sorted((r["language"], r["text"]) for r in spark.read.parquet(out).collect())
    assert got == sorted(tuple(r) for r in distinct_sentences(document_sentences(docs)).collect())


PAGES = "page_id long, url string, language string, html string"


def page(number, *names):
    return "".join(f"<p>Page number {number} says something about {n}. A sentence that all pages have in common.</p>" for n in names)


def test_page_stream_takes_one_snapshot_over_restarts(spark, tmp_path):
    rows = [
        (5, "https://a.org/1", "english", page(5, "cats")),
        (4, "https://a.org/1", "english", page(4, "dogs")),  # the smaller of two snapshots in one batch
        (9, "https://a.org/2", "german", page(9, "birds")),
        (7, "https://a.org/3", "english", ""),
        (8, "https://a.org/4", "dutch", page(8, "fish")),  # no rule for this language
        (1, "https://a.org/1", "english", page(1, "late")),  # later batches: known addresses
        (2, "https://a.org/2", "german", page(2, "late")),
        (3, "https://a.org/5", "english", page(3, "cats", "mice")),
        (6, "https://a.org/6", None, page(6, "none")), (10, None, "english", page(10, "nowhere")), (11, "https://a.org/7", "english", None),
    ]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.createDataFrame([], PAGES).schema
    for part in (rows[:5], rows[5:7], rows[7:]):
        spark.createDataFrame(part, PAGES).coalesce(1).write.mode("append").parquet(source)
        PageCorpus(spark, out, dims.rule_dim(spark)).start(spark.readStream.schema(schema).parquet(source), checkpoint)
    kept = spark.createDataFrame([r for r in rows if r[0] in (4, 9, 3, 10)], PAGES)
    wanted = sorted(map(tuple, distinct_sentences(clean_sentences(page_sentences(kept, dims.rule_dim(spark)))).collect()))
    corpus = PageCorpus(spark, out, dims.rule_dim(spark))
    assert sorted(map(tuple, corpus.read().collect())) == wanted and len(wanted) == 7
    corpus.absorb(spark.createDataFrame(rows[7:], PAGES), 2)  # a batch that is run again
    assert sorted(map(tuple, corpus.read().collect())) == wanted


def test_page_state_is_forgotten_by_the_clock(spark, tmp_path):
    now = [0.0]
    corpora = {keep_for: PageCorpus(spark, str(tmp_path / str(keep_for)), dims.rule_dim(spark), keep_for=keep_for, clock=lambda: now[0]) for keep_for in (None, 25.0)}
    sizes = {keep_for: [] for keep_for in corpora}
    for batch in range(6):
        now[0] = 10.0 * batch
        rows = [(100 * batch + i, f"https://a.org/{batch}/{i}", "english", page(100 * batch + i, "cats")) for i in range(5)]
        rows.append((1000 + batch, "https://same.org/", "english", page(1000 + batch, "dogs")))
        for keep_for, corpus in corpora.items():
            corpus.absorb(spark.createDataFrame(rows, PAGES), batch)
            sizes[keep_for].append(corpus.addresses.read().count())
    assert sizes[None] == [6, 11, 16, 21, 26, 31]
    assert sizes[25.0] == [6, 11, 16, 16, 16, 16]  # those of three batches; the same address counts anew
    said = [r["text"] for r in corpora[None].read().collect()]
    assert len(said) == len(set(said)) == 6 * 5 + 1 + 1
    again = [r["text"] for r in corpora[25.0].read().collect()]
    assert set(said) < set(again) and again.count("A sentence that all pages have in common.") == 2
    assert corpora[25.0].addresses.batches() == [3, 4, 5]


def states(query):
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]


def test_state_is_forgotten_by_the_clock(spark, tmp_path):
    """Many batches of new sentences: without a limit state grows with them, with one it holds those of the last seconds."""
    schema = "doc_id long, language string, text string"
    found = {}
    for keep_for in (None, "1 seconds"):
        name = str(tmp_path / str(bool(keep_for)))
        total = []
        for batch in range(6):
            rows = [(100 * batch + i, "english", f"Batch {batch} brings sentence number {i} of its own.") for i in range(20)]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{name}/in")
            stream = spark.readStream.schema(schema).parquet(f"{name}/in")
            query = run_available(stream_new_sentences(stream, keep_for=keep_for), f"{name}/out", f"{name}/cp")
            total += states(query)[-1:]
            time.sleep(1.2 if keep_for else 0)
        assert spark.read.parquet(f"{name}/out").count() == 120
        found[keep_for] = total
    assert found[None][-1] == 6 * 40  # two levels of 20 sentences a batch
    assert max(found["1 seconds"][2:]) <= 3 * 40


@pytest.mark.parametrize("files", [0, 1, 3])
def test_stream_of_a_table_that_is_a_file_or_a_folder(spark, tmp_path, files):
    from tongues.plans.queries import QUERIES

    rows = [(i, f"The document number {i} has a sentence of its own. Every document has this sentence.", "en") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if files:
        docs.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    else:  # one file by that name
        docs.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["stream_new_sentences"](spark, str(tmp_path)).count() == 10


def test_a_stream_without_rows_gives_none(spark, tmp_path):
    from tongues.plans.queries import QUERIES

    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["stream_new_sentences"](spark, str(tmp_path)).count() == 0
