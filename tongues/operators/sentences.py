"""Splitting, cleaning and filtering of sentences. Row-local and native throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tongues.config import CorpusConfig
from tongues.functions import text as T

DEFAULT = CorpusConfig()


def split_sentences(df: DataFrame, text: str = "text", position: str = "pos") -> DataFrame:
    """Split after ``.``, ``!`` or ``?`` followed by white space; blank texts give no rows."""
    others = [c for c in df.columns if c != text]
    body = df.withColumn(text, T.strip(F.col(text))).filter(F.col(text) != "")
    return body.select(*others, F.posexplode(F.split(F.col(text), T.SENTENCE_END))).select(
        *others, F.col("pos").cast("long").alias(position), F.col("col").alias(text)
    )


def normalize_ws(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, T.normalize_ws(F.col(text)))


def length_ok(text: Column, config: CorpusConfig = DEFAULT) -> Column:
    return F.length(text).between(config.min_sentence_length, config.max_sentence_length)


def words_ok(text: Column, config: CorpusConfig = DEFAULT) -> Column:
    return T.has_words(text, config.min_words)


def digits_ok(text: Column, config: CorpusConfig = DEFAULT) -> Column:
    return T.digit_count(text) <= F.length(text) * F.lit(config.max_digit_share)


def no_url(text: Column) -> Column:
    return ~T.has_url(text)


def no_email(text: Column) -> Column:
    return ~T.has_email(text)


def filter_length(df: DataFrame, config: CorpusConfig = DEFAULT, text: str = "text") -> DataFrame:
    return df.filter(length_ok(F.col(text), config))


def filter_min_words(df: DataFrame, config: CorpusConfig = DEFAULT, text: str = "text") -> DataFrame:
    return df.filter(words_ok(F.col(text), config))


def filter_digit_ratio(df: DataFrame, config: CorpusConfig = DEFAULT, text: str = "text") -> DataFrame:
    return df.filter(digits_ok(F.col(text), config))


def filter_url(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(no_url(F.col(text)))


def filter_email(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(no_email(F.col(text)))


def capitalize_first(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, T.capitalize_first(F.col(text)))


def _usable(df: DataFrame, config: CorpusConfig, text: str) -> DataFrame:
    """Every filter on collapsed sentences, cheap ones first, then the capital."""
    column = F.col(text)
    kept = df.filter(
        length_ok(column, config)
        & words_ok(column, config)
        & no_email(column)
        & no_url(column)
        & digits_ok(column, config)
    )
    return capitalize_first(kept, text)


def clean_sentences(df: DataFrame, config: CorpusConfig = DEFAULT, text: str = "text") -> DataFrame:
    """Normalise, filter and capitalise rows that are single sentences.

    Collapsing white space never lengthens a sentence, so short ones go before it. The
    collapsed text passes through a generator: a plain column would be substituted into
    each of the filters and its regex run once per use.
    """
    columns = [c for c in df.columns if c != text]
    long_enough = df.filter(F.length(text) >= config.min_sentence_length)
    collapsed = long_enough.select(*columns, F.explode(F.array(T.normalize_ws(F.col(text)))).alias(text))
    return _usable(collapsed, config, text)


def document_sentences(
    df: DataFrame, config: CorpusConfig = DEFAULT, text: str = "text", position: str = "pos"
) -> DataFrame:
    """Clean sentences of whole documents.

    Same rows as ``clean_sentences(split_sentences(df))``, but white space is collapsed
    once per document, after which a sentence end is a mark followed by one space.
    """
    columns = [c for c in df.columns if c != text]
    pieces = df.select(*columns, F.posexplode(F.split(T.normalize_ws(F.col(text)), r"(?<=[.!?]) ")))
    named = pieces.select(*columns, F.col("pos").cast("long").alias(position), F.col("col").alias(text))
    return _usable(named, config, text)
