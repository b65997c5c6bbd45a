"""The most used n-grams of a corpus of any size, exactly, without counting all of them.

A first pass keeps a summary of bounded size in each task: uses of the n-grams that are used most there, and how
many uses any other may have lost. Summaries add up, and tell which n-grams can be among the most used ones. A second pass counts those, and no
others. What is moved is a summary or a count of the survivors for each task, not every different n-gram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.functions.grams import TermCounter, cached, slices, word_grams
from tongues.operators.ngrams import text_frequencies, vocabulary
from tongues.sources.scratch import stored

#: N-grams in a task's summary, words that are counted before their n-grams are, and terms that a second pass counts at most.
SUMMARY, WORDS, SURVIVORS = 1 << 16, 1 << 16, 1 << 16


class Summary:
    """Uses of terms, at most ``size`` of them after each cut: ``uses`` are too small by ``lost`` at most, and terms that are not listed have no more than that.

    A cut takes the same number from every term, so much that ``size`` remain; this is the batched form of counting with
    decrements, whose summaries can be merged by adding both.
    """

    def __init__(self, size: int):
        self.size, self.lost = size, 0
        self.uses: dict[str, int] = {}

    def add(self, uses: dict[str, int]) -> None:
        mine = self.uses
        for term, n in uses.items():
            mine[term] = mine.get(term, 0) + n
        if len(mine) > 2 * self.size:
            self.cut()

    def cut(self) -> None:
        if len(self.uses) > self.size:
            counts = np.fromiter(self.uses.values(), np.int64, len(self.uses))
            less = int(np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1])
            self.lost += less
            self.uses = {term: n - less for term, n in self.uses.items() if n > less}


def term_summary(df: DataFrame, text: str = "text", min_n: int = 2, max_n: int = 5, size: int = SUMMARY) -> DataFrame:
    """``(term, uses, lost)``: a summary of each task; the row without a term tells what its other rows have lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = cached(lambda word: word_grams(word, min_n, max_n))
        words: Counter = Counter()
        summary = Summary(size)

        def fold() -> None:
            uses: dict[str, int] = {}
            for word, times in words.items():
                for term in grams(word):
                    uses[term] = uses.get(term, 0) + times
                if len(uses) >= size:
                    summary.add(uses)
                    uses = {}
            words.clear()
            summary.add(uses)

        for batch in batches:
            for value in batch.column(0):
                words.update((value.as_py() or "").lower().split())
                if len(words) >= WORDS:
                    fold()
        fold()
        summary.cut()
        terms = [*summary.uses, None]
        uses = [*summary.uses.values(), 0]
        lost = [0] * len(summary.uses) + [summary.lost]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(uses, pa.int64()), pa.array(lost, pa.int64())], ["term", "uses", "lost"])

    return df.select(text).mapInArrow(run, "term string, uses long, lost long")


def listed_frequencies(df: DataFrame, terms: list[str], text: str = "text", min_n: int = 2, max_n: int = 5) -> DataFrame:
    """``(term, df, cf)`` of the given terms: each task adds up arrays as long as the list."""
    shared = df.sparkSession.sparkContext.broadcast(terms)  # SURVIVORS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(shared.value, min_n, max_n)
        texts, uses = np.zeros(counter.size, np.int64), np.zeros(counter.size, np.int64)
        for batch in batches:
            values = batch.column(0).to_pylist()
            for start, stop in slices(values):
                _, term, n = counter.count(values[start:stop])
                texts += np.bincount(term, minlength=counter.size)
                uses += np.bincount(term, n, counter.size).astype(np.int64)
        there = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([pa.array([shared.value[i] for i in there.tolist()], pa.string()), pa.array(texts[there]), pa.array(uses[there])], ["term", "df", "cf"])

    found = df.select(text).mapInArrow(run, "term string, df long, cf long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def frequent_terms(
    df: DataFrame, text: str = "text", max_features: int = 1500, min_df: int = 2, max_df: float = 0.9, min_n: int = 2, max_n: int = 5,
    size: int = SUMMARY, survivors: int = SURVIVORS,
) -> DataFrame:
    """The rows of ``operators.ngrams.vocabulary`` of all n-grams of ``df``, found through summaries.

    A threshold is safe when ``max_features`` terms that qualify have been counted to reach it: every term that was not counted
    has fewer uses. The first one leaves room for as many terms that do not qualify; where it does not reach, it is lowered, and
    where the summaries cannot tell terms below it from those above it, all n-grams are counted.
    """
    texts = df.select(text)
    summary = stored(term_summary(texts, text, min_n, max_n, size), "term-summary")
    lost = summary.agg(F.coalesce(F.sum("lost"), F.lit(0))).first()[0]
    least = summary.filter("term IS NOT NULL").groupBy("term").agg(F.sum("uses").alias("uses"))
    n = texts.count()
    wanted = 2 * max_features
    while True:
        best = least.orderBy(F.desc("uses")).select("uses").limit(wanted).collect()
        threshold = best[-1]["uses"] if len(best) == wanted else 1
        if threshold <= lost:
            break  # a term that no summary lists may reach the threshold
        rows = least.filter(F.col("uses") >= threshold - lost).select("term").limit(survivors + 1).collect()
        if len(rows) > survivors:
            break
        counted = stored(listed_frequencies(texts, sorted(r["term"] for r in rows), text, min_n, max_n), "term-counts")
        fit = (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n) & (F.col("cf") >= threshold)
        if threshold == 1 or counted.filter(fit).count() >= max_features:
            return vocabulary(counted, texts, max_features, min_df, max_df)
        wanted *= 4
    return vocabulary(text_frequencies(texts, text, min_n, max_n), texts, max_features, min_df, max_df)
