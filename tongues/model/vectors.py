"""Sparse TF-IDF vectors and the combined feature vector for MLlib, built column by column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tongues.functions import stats
from tongues.functions.grams import SLICE_CHARS, SLICE_TEXTS, TermCounter, slices

#: The stored form of a vector: 0 for sparse, its size, and the places and values that are not zero.
_VECTOR = [("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]


def _vectors(rows: int, size: int, row: np.ndarray, place: np.ndarray, value: np.ndarray) -> pa.Array:
    """Sparse vectors of ``size`` for ``rows`` rows from entries in order of row and place."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]), pa.int32())
    columns = [
        pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, size, np.int32)),
        pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(value)),
    ]
    return pa.StructArray.from_arrays(columns, fields=[pa.field(*f) for f in _VECTOR])


class BatchFeatures:
    """The features of texts in Arrow batches, as flat entries: TF-IDF weights of ``terms``, followed by ``extra`` columns of numbers.

    Words are looked up once for each worker, and counts, weights and norms are those of flat arrays. Nothing
    is done row by row but to split a text into words.
    """

    def __init__(self, terms: Sequence[tuple[str, float]], min_n: int, max_n: int, extra: int = 0):
        self.counter = TermCounter([term for term, _ in terms], min_n, max_n)
        self.idf = np.array([weight for _, weight in terms], dtype=np.float64)
        self.extra, self.size = extra, len(terms) + extra

    def slices(self, batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """``start, stop`` and entries ``row, place, value`` in order, of parts of a batch; ``text`` is the place of the texts, and the last columns are the extra ones."""
        texts, width = batch.column(text).to_pylist(), batch.num_columns - self.extra
        for start, stop in slices(texts, SLICE_TEXTS, SLICE_CHARS):
            row, place, uses = self.counter.count(texts[start:stop])
            value = (1.0 + np.log(uses)) * self.idf[place]
            value /= np.sqrt(np.bincount(row, value * value, stop - start))[row]
            if self.extra:
                columns = [batch.column(width + k).slice(start, stop - start).to_numpy(zero_copy_only=False) for k in range(self.extra)]
                more = np.column_stack(columns).astype(np.float64)
                of, which = np.nonzero(more)
                # in a row, numbers come after terms: where an entry goes follows from how many of the other kind come before it
                terms_at = np.arange(len(row)) + np.append(0, np.cumsum(np.bincount(of, minlength=stop - start)))[row]
                more_at = np.arange(len(of)) + np.cumsum(np.bincount(row, minlength=stop - start))[of]
                merged = [np.empty(len(row) + len(of), kind) for kind in (np.int64, np.int64, np.float64)]
                for out, terms, numbers in zip(merged, (row, place, value), (of, which + len(self.idf), more[of, which])):
                    out[terms_at], out[more_at] = terms, numbers
                row, place, value = merged
            yield start, stop, row, place, value


def stat_columns(text: str) -> dict:
    """The 18 statistics as double columns, under names of their own."""
    return {f"_s_{name}": value.cast("double") for name, value in stats.all_features(F.col(text)).items()}


def _with_vectors(df: DataFrame, terms: Sequence[tuple[str, float]], text: str, output: str, min_n: int, max_n: int, extra: Sequence[str]) -> DataFrame:
    """``df`` without ``extra``, with a vector of the weights of ``terms`` followed by the numbers in ``extra``: one Arrow column of vectors for a batch."""
    kept = [f for f in df.schema.fields if f.name != output and f.name not in extra]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(output, VectorUDT())])
    terms, size = list(terms), len(terms) + len(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = BatchFeatures(terms, min_n, max_n, len(extra))
        for batch in batches:
            for start, stop, row, place, value in features.slices(batch, names.index(text)):
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, _vectors(stop - start, size, row, place, value)], names=schema.names)

    made = df.select(*names, *extra).mapInArrow(run, schema)
    # the size travels as metadata, so that assembling needs no look at the data
    return made.select(*names, F.col(output).alias(output, metadata={"ml_attr": {"num_attrs": size}}))


def tfidf_vectors(
    df: DataFrame,
    terms: Sequence[tuple[str, float]],
    text: str = "text",
    output: str = "tfidf",
    min_n: int = 2,
    max_n: int = 5,
) -> DataFrame:
    """Row-local equivalent of ``operators.ngrams.tfidf_rows`` for a fitted vocabulary.

    ``terms`` is the vocabulary in index order with its idf. A null text counts as empty; a text without terms has the zero vector.
    """
    return _with_vectors(df, terms, text, output, min_n, max_n, ())


def feature_vectors(df: DataFrame, text: str = "text", output: str = "stats") -> DataFrame:
    """The 18 statistics, in their fixed order, as one vector."""
    columns = {f"_s_{name}": value for name, value in stats.all_features(F.col(text)).items()}
    wide = df.withColumns(columns)
    assembled = VectorAssembler(inputCols=list(columns), outputCol=output).transform(wide)
    return assembled.drop(*columns)


def feature_matrix(
    df: DataFrame,
    terms: Sequence[tuple[str, float]],
    text: str = "text",
    output: str = "features",
    min_n: int = 2,
    max_n: int = 5,
) -> DataFrame:
    """N-gram weights followed by the statistics, in one vector that is put together once."""
    columns = stat_columns(text)
    return _with_vectors(df.withColumns(columns), terms, text, output, min_n, max_n, list(columns))
