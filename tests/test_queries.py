"""A cross-section of the registered queries against their SQL; ``check_queries.py`` runs them all."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connection

DIRECTORY = "/root/testdata/sf0.001"
SOME = [
    "page_candidates", "page_frontier", "clean_sentences", "capped_corpus", "hybrid_topup", "new_sentences",
    "augment", "augment_counts", "length_stats", "balance", "stratified_split", "stratified_folds", "class_weights",
    "feat_vector", "vocabulary", "tfidf", "top_n", "mixed_note", "class_report", "confusion_matrix",
]


@pytest.fixture(scope="module")
def con():
    return connection(DIRECTORY)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, DIRECTORY, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
