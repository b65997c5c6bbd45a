"""Character n-grams inside word boundaries, document frequencies and TF-IDF."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tongues.functions.grams import CACHED_LENGTH, cached, count_grams, word_grams
from tongues.functions.text import WS

CHUNK = 200  # characters of a word handled at a time
FLUSH_POSTINGS = 200_000  # rows handed to Spark at a time
FLUSH_TERMS = 500_000  # different terms counted in a Python worker at a time
MAX_BROADCAST_TERMS = 200_000


def char_ngrams(words: DataFrame, min_n: int = 2, max_n: int = 5) -> DataFrame:
    """Every n-gram of every word padded with one space on both sides.

    A word is cut into overlapping chunks first, which keeps the work linear in its
    length. The generators and ``substring`` run in generated code.
    """
    others = [c for c in words.columns if c != "word"]
    padded = words.select(*others, F.concat(F.lit(" "), "word", F.lit(" ")).alias("_w"))
    chunk = padded.select(
        *others, "_w", F.explode(F.sequence(F.lit(1), F.length("_w") - (min_n - 1), F.lit(CHUNK))).alias("_at")
    ).select(*others, F.substring("_w", F.col("_at"), F.lit(CHUNK + max_n - 1)).alias("_c"))
    size = chunk.filter(F.length("_c") >= min_n).select(
        *others, "_c", F.explode(F.sequence(F.lit(min_n), F.least(F.lit(max_n), F.length("_c")))).alias("_n")
    )
    start = F.sequence(F.lit(1), F.least(F.lit(CHUNK), F.length("_c") - F.col("_n") + 1))
    return size.select(*others, "_c", "_n", F.explode(start).alias("_i")).select(
        *others, F.substring("_c", F.col("_i"), F.col("_n")).alias("term")
    )


def term_freq(
    df: DataFrame, ids: Sequence[str], text: str = "text", min_n: int = 2, max_n: int = 5
) -> DataFrame:
    """``(ids, term, tf)``, one text at a time and without a shuffle.

    All postings of a text come from its own row, so they are counted there. Grouping
    exploded n-grams by (id, term) instead would shuffle many times the corpus to bring
    together rows that were never apart.
    """
    keys = list(ids)
    fields = "".join(f"{name} {df.schema[name].dataType.simpleString()}, " for name in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = cached(lambda word: word_grams(word, min_n, max_n))
        for batch in batches:
            rows, sizes, terms, uses = [], [], [], []

            def flush(batch=batch):
                at = pa.array(np.repeat(np.array(rows, dtype="int64"), np.array(sizes, dtype="int64")))
                columns = [batch.column(i).take(at) for i in range(len(keys))]
                columns += [pa.array(terms, pa.string()), pa.array(uses, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=[*keys, "term", "tf"])

            for row, value in enumerate(batch.column(len(keys))):
                counts = count_grams(value.as_py(), grams)
                rows.append(row)
                sizes.append(len(counts))
                terms.extend(counts.keys())
                uses.extend(counts.values())
                if len(terms) >= FLUSH_POSTINGS:
                    yield flush()
                    rows, sizes, terms, uses = [], [], [], []
            yield flush()

    return df.select(*keys, text).mapInArrow(run, f"{fields}term string, tf long")


def term_counts(df: DataFrame, text: str = "text", min_n: int = 2, max_n: int = 5) -> DataFrame:
    """``(term, occurrences)`` over a whole corpus, from counts of its different words."""
    word = df.select(F.explode(F.split(F.lower(text), WS + "+")).alias("word")).filter(F.col("word") != "")
    counted = word.groupBy("word").agg(F.count("*").alias("uses"))
    return char_ngrams(counted, min_n, max_n).groupBy("term").agg(F.sum("uses").alias("occurrences"))


def doc_freq(postings: DataFrame) -> DataFrame:
    """``(term, df, cf)``: texts containing a term, and its uses in all of them."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def text_frequencies(df: DataFrame, text: str = "text", min_n: int = 2, max_n: int = 5) -> DataFrame:
    """``doc_freq(term_freq(df))`` with counts summed over batches of texts before the shuffle.

    Terms repeat across texts far more than within one, so few of the postings remain. A word's terms are looked up once
    and kept as numbers, so a text's different terms are found in flat arrays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, int] = {}  # a number for each term
        places: dict[str, np.ndarray] = {}  # the different terms of a word
        words: Counter = Counter()  # uses of a word, which give the uses of its terms
        texts = np.zeros(FLUSH_TERMS, np.int64)  # texts holding a term
        last = np.zeros(FLUSH_TERMS, np.int64)  # where a text's list of terms names a term last

        def place(word: str) -> np.ndarray:
            nonlocal texts, last
            found = places.get(word)
            if found is None:
                found = np.array([index.setdefault(g, len(index)) for g in dict.fromkeys(word_grams(word, min_n, max_n))], np.int64)
                if len(index) > len(texts):
                    more = np.zeros(len(index), np.int64)
                    texts, last = np.concatenate([texts, more]), np.concatenate([last, more])
                if len(word) <= CACHED_LENGTH:
                    places[word] = found
            return found

        def flush():
            nonlocal texts, last
            uses = [0] * len(index)
            for word, times in words.items():
                for term in word_grams(word, min_n, max_n):
                    uses[index[term]] += times
            columns = [pa.array(list(index), pa.string()), pa.array(texts[:len(index)]), pa.array(uses, pa.int64())]
            index.clear()
            places.clear()
            words.clear()
            texts, last = np.zeros(FLUSH_TERMS, np.int64), np.zeros(FLUSH_TERMS, np.int64)
            return pa.RecordBatch.from_arrays(columns, names=["term", "df", "cf"])

        for batch in batches:
            for value in batch.column(0):
                found = (value.as_py() or "").lower().split()
                words.update(found)
                if found:
                    terms = np.concatenate([place(word) for word in dict.fromkeys(found)])
                    at = np.arange(len(terms))
                    last[terms] = at
                    texts[terms[last[terms] == at]] += 1  # each term once
                if len(index) >= FLUSH_TERMS or len(words) >= FLUSH_TERMS:
                    yield flush()
        yield flush()

    partial = df.select(text).mapInArrow(run, "term string, df long, cf long")
    return partial.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def vocabulary(
    frequencies: DataFrame,
    texts: DataFrame,
    max_features: int = 1500,
    min_df: int = 2,
    max_df: float = 0.9,
) -> DataFrame:
    """``(term, term_index, df, cf)``: the most used terms that are neither rare nor everywhere.

    Ties at the cut go to the smaller term; indices follow term order. The cut is a
    top-k over partitions, so only ``max_features`` rows are ever ordered in one place.
    """
    n = texts.agg(F.count("*")).scalar()
    kept = frequencies.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n))
    best = kept.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
    index = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1).cast("long")
    return best.select("term", index.alias("term_index"), "df", "cf")


def idf_weight(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def idf(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """Add the smoothed inverse document frequency."""
    n = texts.agg(F.count("*")).scalar()
    return terms.withColumn("idf", idf_weight(F.col("df"), n))


def tfidf(postings: DataFrame, terms: DataFrame, ids: Sequence[str], max_features: int = 1500) -> DataFrame:
    """``(ids, term_index, weight)`` with sublinear tf, L2-normalised per text.

    ``terms`` holds at most ``max_features`` rows, which decides whether it is
    broadcast. Postings outside it are dropped before anything is grouped.
    """
    side = terms.select("term", "term_index", "idf")
    side = F.broadcast(side) if max_features <= MAX_BROADCAST_TERMS else side
    weighted = postings.join(side, "term").select(
        *ids, "term_index", ((F.log("tf") + 1) * F.col("idf")).alias("_w")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*ids)))
    return weighted.select(*ids, "term_index", (F.col("_w") / norm).alias("weight"))


def tfidf_rows(
    df: DataFrame, vocabulary: Sequence[tuple[str, float]], ids: Sequence[str], text: str = "text", min_n: int = 2, max_n: int = 5
) -> DataFrame:
    """``(ids, term_index, weight)`` of texts, without a shuffle: counts, weights and norm are of one row.

    ``vocabulary`` lists ``(term, idf)`` in index order; its size is that of ``max_features``. Terms outside it
    never leave the worker.
    """
    keys = list(ids)
    fields = "".join(f"{name} {df.schema[name].dataType.simpleString()}, " for name in keys)
    index = {term: i for i, (term, _) in enumerate(vocabulary)}
    idfs = np.array([weight for _, weight in vocabulary])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = cached(lambda word: [index[g] for g in word_grams(word, min_n, max_n) if g in index])
        for batch in batches:
            rows, found, weights = [], [], []

            def flush(batch=batch):
                at = pa.array(np.repeat(np.array(rows, dtype="int64"), [len(f) for f in found]))
                columns = [batch.column(i).take(at) for i in range(len(keys))]
                columns += [pa.array(np.concatenate(x) if x else np.empty(0, k), t) for x, k, t in
                            ((found, "int64", pa.int64()), (weights, "float64", pa.float64()))]
                return pa.RecordBatch.from_arrays(columns, names=[*keys, "term_index", "weight"])

            held = 0
            for row, value in enumerate(batch.column(len(keys))):
                counts = count_grams(value.as_py(), grams)
                if not counts:
                    continue
                at = np.fromiter(counts, "int64", len(counts))
                w = (np.log(np.fromiter(counts.values(), "float64", len(counts))) + 1.0) * idfs[at]
                rows.append(row)
                found.append(at)
                weights.append(w / np.sqrt(w @ w))
                held += len(at)
                if held >= FLUSH_POSTINGS:
                    yield flush()
                    rows, found, weights, held = [], [], [], 0
            yield flush()

    return df.select(*keys, text).mapInArrow(run, f"{fields}term_index long, weight double")
