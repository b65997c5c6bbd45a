"""Registered queries against SQL, the pipeline stage by stage, and the guard around the subpackage."""

from __future__ import annotations

import importlib
import re
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.check_queries import compare, connection
from tests.llm.test_native import plain_lines
from tongues.llm.oracles import ORACLES
from tongues.llm.queries import QUERIES

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connection(DIRECTORY), DIRECTORY, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op2_mixing", "op4_sentencepiece", "op6_language_id", "op7_html_text"])
def test_whole_tables(spark, name):
    table = "pages" if name == "op7_html_text" else "documents"
    assert entry.queries()[name](spark, DIRECTORY).count() == spark.read.parquet(f"{DIRECTORY}/{table}.parquet").count()


def plain_shingles(text):
    words = re.findall("[^ \t-\r]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages(spark, documents):
    columns = list(corpus_pipeline.COLUMNS)
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_copies", "mixing", "tokens"]
    found = stages["language"](spark, docs, DIRECTORY)
    assert found.columns == columns and found.count() == docs.count()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lines = stages["lines"](spark, docs, DIRECTORY)
    wanted = plain_lines(rows)
    assert lines.columns == columns
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in lines.collect()) == sorted((i, kept, len(kept)) for i, _, _, kept in wanted)
    near = stages["near_copies"](spark, docs, DIRECTORY)
    sets = {i: plain_shingles(t) for i, t in rows}
    kept = {r["doc_id"] for r in near.collect()}
    assert near.columns == columns and near.count() == len(kept)

    def most(i, others):
        return max((len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in others if j != i), default=0.0)

    assert all(most(i, kept) < 0.8 for i in kept)  # of similar texts one stays
    assert all(most(i, sets) >= 0.5 for i in sets.keys() - kept)  # and texts of their own are left alone
    mixed = stages["mixing"](spark, docs, DIRECTORY)
    assert mixed.columns == columns and {r["doc_id"] for r in mixed.collect()} <= {i for i, _ in rows}
    tokens = stages["tokens"](spark, docs, DIRECTORY)
    assert tokens.count() == docs.count() and tokens.filter("round_trip").count() == docs.count()


def test_stages_take_odd_tables(spark, documents):
    rows = [(1, None, None), (None, "", None), (2, "12 34", "en"), (3, "the same long line\nthe same long line", "en"), (3, "the same long line\nthe same long line", "en")]
    for docs in (documents(rows, clash=True), documents([])):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, DIRECTORY).count() <= 2 * len(rows), name


def test_pipeline_runs(spark):
    found = corpus_pipeline.run(spark, DIRECTORY)
    assert found.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and 0 < found.count() <= 400


def test_entry_without_the_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n.startswith(("tongues.llm", "corpus_pipeline"))]:
        monkeypatch.setitem(sys.modules, name, None)
    bare = importlib.reload(entry)
    try:
        assert bare.queries() and not any(n.startswith("op") or n == "pipeline" for n in bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
