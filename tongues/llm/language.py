"""Language identification: TF-IDF of character n-grams, regularised logistic regression, calibrated scores."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tongues.llm.linear import Model, Settings, fit, inverse_frequencies
from tongues.llm.sampling import labelled_sample

#: Hash buckets of n-grams, and the lengths of n-grams.
BUCKETS = 1 << 15
LENGTHS = (1, 2, 3)
#: Labelled rows per language that the weights are fitted on.
PER_LANGUAGE = 500
UNKNOWN = "und"
_PIECE = 1 << 18
_SHIFT = np.uint64(64 - 15)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_WORD_SIGN = re.compile(r"[^\W\d_]")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the lower-cased text's n-grams and how often each occurs.

    The whole text is read, in pieces that overlap by the longest n-gram less one.
    """
    text, overlap = text.lower(), max(LENGTHS) - 1
    sums = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(text), _PIECE):
        piece = text[at:at + _PIECE + overlap]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        for n in LENGTHS:
            count = min(len(codes) - n + 1, _PIECE)
            if count > 0:
                mixed = codes[:count] * _ODD[0] + np.uint64(n)
                for k in range(1, n):
                    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[k] + codes[k:k + count]
                mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[0]
                sums += np.bincount((mixed >> _SHIFT).astype(np.int64), minlength=BUCKETS)
    positions = np.flatnonzero(sums)
    return positions, sums[positions]


def has_letter(text: str) -> bool:
    """Whether a code point is a letter by its Unicode category; other numerals than digits are signs of words but no letters."""
    return any(m[0].isalpha() for m in _WORD_SIGN.finditer(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are kept for tests: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and, by bucket, of texts that have it; each task adds up its own before anything is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                sums[gram_counts(t.as_py() or "")[0]] += 1
                sums[BUCKETS] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros(BUCKETS + 1)
    for r in found.collect():  # one row per bucket at most
        sums[r["bucket"]] = r["n"]
    return int(sums[BUCKETS]), sums[:BUCKETS]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, settings: Settings | None = None) -> Model:
    """Learn from text and non-null ``lang`` of the documents that are not held out.

    Document frequencies cover all of these; weights are fitted on ``per_language`` rows of each
    language at most, and the temperature on a fifth of those that the weights have not seen.
    """
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("lang").alias("label"), "text")
    count, containing = document_frequencies(rows)
    sample = labelled_sample(rows, per_language)
    classes = sorted({label for label, _ in sample})
    empty = Model(classes, np.zeros((BUCKETS + 1, len(classes))), inverse_frequencies(count, containing))
    features = [empty.weigh(*gram_counts(text)) for _, text in sample]
    return fit(features, [classes.index(label) for label, _ in sample], classes, empty.idf, settings)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    Only the text counts. Null texts and texts without a letter are ``und`` with score 0, and so are all
    texts when no language was learned; ties go to the language first in the alphabet.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(batch.schema.get_field_index("text")):
                text = value.as_py()
                if not m.classes or text is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = m.probabilities(m.weigh(*gram_counts(text)))
                best = int(p.argmax())
                names.append(m.classes[best])
                scores.append(min(1.0, float(p[best])))
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; a null ``doc_id`` is not held out."""
    model = train(docs, per_language)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
