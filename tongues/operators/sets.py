"""Set operations on sentence corpora; a corpus is unique on ``(language, text)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tongues.config import CorpusConfig, TopUpConfig
from tongues.operators.ranking import per_label, sample_key, top_k
from tongues.sources.dims import CODES

KEY = ("language", "text")
BLOCK = 1 << 16  # pages per block of the running count


def distinct_sentences(df: DataFrame, on: Sequence[str] = KEY) -> DataFrame:
    return df.select(*on).distinct()


def new_sentences(df: DataFrame, known: DataFrame, on: Sequence[str] = KEY, keep: Sequence[str] = ()) -> DataFrame:
    """Distinct rows of ``df``, with the columns ``keep``, whose key is not in ``known``. Both sides are unique before the join."""
    left = df.select(*dict.fromkeys([*KEY, *on, *keep])).distinct()
    return left.join(known.select(*on).distinct(), list(on), "left_anti").select(*left.columns)


def union_corpora(first: DataFrame, *others: DataFrame) -> DataFrame:
    merged = first.select(*KEY)
    for other in others:
        merged = merged.unionByName(other.select(*KEY))
    return merged.distinct()


def capped_corpus(
    df: DataFrame,
    cap: int = CorpusConfig().max_sentences_per_language,
    order: str = "page_order",
    languages: Sequence[str] = CODES,
    found: Mapping[str, int] | None = None,
) -> DataFrame:
    """Distinct sentences of the first pages of each language, until there are ``cap`` of them.

    A page is read only while fewer than ``cap`` sentences were found before it, so the
    last page may overshoot. ``order`` is a non-negative integer, unique per page
    within a language. Pages are counted in blocks of consecutive order: the first block that reaches
    the cap is found from block sums, and only its pages are put in sequence. ``found`` tells how many sentences
    a language has from earlier pages, none by default.
    """
    start = F.lit(0).cast("long")
    for code, n in (found or {}).items():
        start = F.when(F.col("language") == code, F.lit(n).cast("long")).otherwise(start)
    first_seen = df.groupBy(*KEY).agg(F.min(order).alias("page_order"))
    per_page = first_seen.groupBy("language", "page_order").agg(F.count("*").alias("_new"))
    per_page = per_page.withColumn("_block", F.floor(F.col("page_order") / BLOCK))

    earlier = Window.partitionBy("language").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        per_page.groupBy("language", "_block").agg(F.sum("_new").alias("_sum"))
        .withColumn("_before", start + F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    last = Window.partitionBy("language")
    ending = (
        blocks.filter(F.col("_before") < cap)
        .withColumn("_last", F.max("_block").over(last))
        .filter(F.col("_block") == F.col("_last"))
        .select("language", "_last", "_before")
    )
    inside = per_label(per_page, ending, "language", languages).filter(F.col("_block") == F.col("_last"))
    previous = Window.partitionBy("language").orderBy("page_order").rowsBetween(Window.unboundedPreceding, -1)
    used = (
        inside.withColumn("_seen", F.col("_before") + F.coalesce(F.sum("_new").over(previous), F.lit(0)))
        .filter(F.col("_seen") < cap)
        .groupBy("language").agg(F.max("page_order").alias("_until"))
    )
    return (
        per_label(first_seen, used, "language", languages)
        .filter(F.col("page_order") <= F.col("_until"))
        .select(*KEY)
    )


def hybrid_topup(
    corpus: DataFrame,
    seed: DataFrame,
    config: TopUpConfig = TopUpConfig(),
    languages: Sequence[str] = CODES,
    random_seed: int = 42,
) -> DataFrame:
    """Fill up small languages from ``seed`` when the whole corpus is too small.

    ``languages`` are the languages a collection was attempted for; one that found
    nothing counts as empty and is filled too. Languages that are large enough, and
    every language of a corpus that is large enough, pass unchanged.
    """
    corpus = corpus.select(*KEY)
    spark = corpus.sparkSession
    attempted = spark.createDataFrame([(code,) for code in languages], "language string")
    counts = corpus.groupBy("language").agg(F.count("*").alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    needy = (
        attempted.join(counts, "language", "left")
        .filter((F.coalesce("_n", F.lit(0)) < config.min_per_language) & (total < config.min_total))
        .select("language", F.lit(True).alias("_needy"))
    )
    marked = corpus.join(F.broadcast(needy), "language", "left")
    kept = marked.filter(F.col("_needy").isNull()).select(*KEY)
    short = marked.filter(F.col("_needy")).select(*KEY)
    extra = seed.select(*KEY).join(F.broadcast(needy), "language").select(*KEY)
    pool = short.unionByName(extra).distinct().withColumn("_key", sample_key("text", random_seed))
    filled = top_k(pool, ["language"], ["_key", "text"], config.limit)
    return kept.unionByName(filled.select(*KEY))
