"""Ordering inside a few very large groups.

A corpus has a handful of labels, so a window over ``label`` would put a third of
all rows into one task. These helpers reach the same result with bounded groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tongues.sources.dims import CODES

SALTS = 64
BUCKET_DIGITS = 4  # leading hex digits of an md5 key: 65,536 even buckets per group


def sample_key(text: str, seed: int) -> Column:
    """Reproducible pseudo-random order of texts."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(text)))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, salts: int = SALTS) -> DataFrame:
    """First ``k`` rows of every group.

    Map tasks keep at most ``k`` rows per group before the shuffle. Salting by task
    then spreads what is left of a hot group, and the last step sees at most
    ``salts * k`` rows of it. Any salting gives the same rows.
    """
    salted = df.withColumn("_salt", F.spark_partition_id() % F.lit(salts))
    for keys in ([*group, "_salt"], list(group)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = salted.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
    return salted.drop("_salt")


def listed(label: str, labels: Sequence[str]) -> Column:
    """The label, or a failure of the job when it is not one of ``labels``."""
    message = F.concat(F.lit("label not in the language dimension: "), F.coalesce(F.col(label), F.lit("null")))
    return F.when(F.col(label).isin(*labels), F.col(label)).otherwise(F.raise_error(message))


def of_labels(stats: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """The rows of ``stats`` for listed labels: with one row per label, ``len(labels)`` at most."""
    dimension = stats.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(labels)], f"{label} string")
    return dimension.join(stats, label)


def per_label(df: DataFrame, stats: DataFrame, label: str, labels: Sequence[str] = CODES) -> DataFrame:
    """Attach one row of statistics per label without moving ``df``.

    The broadcast side is joined with the labels first, which bounds it. A row whose label is not listed
    stops the job, so no statistics that are needed can be missing.
    """
    small = of_labels(stats, label, labels)
    return df.withColumn(label, listed(label, labels)).join(F.broadcast(small), label, "left")


def _bucket_sizes(keyed: DataFrame, group: str, digits: int) -> DataFrame:
    """Rows per (group, bucket), the rows in earlier buckets, and the size of the group."""
    sizes = keyed.groupBy(group, F.left("_key", F.lit(digits)).alias("_bucket")).agg(F.count("*").alias("_here"))
    ordered = Window.partitionBy(group).orderBy("_bucket")
    return sizes.select(
        group,
        "_bucket",
        "_here",
        F.coalesce(F.sum("_here").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_here").over(Window.partitionBy(group)).alias("_total"),
    )


def rank_by_key(
    df: DataFrame, group: str, text: str, seed: int, rank: str = "rank", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Position of every row in the order of (md5 key, text) within its group; copies of a text follow each other.

    Rows that are equal in all columns are counted before the shuffle and expanded by generated
    sequences at the end. Copies that differ in other columns go to one of ``SALTS`` parts by a hash of these; a part's offset
    comes from counts of the parts. So a task orders a part of one text's copies at most, and bucket counts,
    ``16 ** digits`` per group, tell what comes before a text. Columns must be comparable.
    """
    columns = df.columns
    others = [c for c in columns if c not in (group, text)]
    part = F.pmod(F.xxhash64(*others), F.lit(SALTS)) if others else F.lit(0).cast("long")
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_part", part).withColumn("_key", sample_key(text, seed))
    counted = counted.withColumn("_bucket", F.left("_key", F.lit(digits)))
    keys = [group, "_bucket", "_key", text, "_part"]
    # of the parts in a bucket, what comes before each; of the buckets, likewise
    parts = counted.groupBy(*keys).agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy(group, "_bucket").orderBy("_key", text, "_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy(group, "_bucket").agg(F.sum("_sum").alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    offsets = parts.withColumn("_within", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).join(buckets, [group, "_bucket"])
    offsets = offsets.select(*keys, (F.col("_before") + F.col("_within")).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*(others or [text])).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_above", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    placed = placed.join(offsets.hint("merge"), keys)  # the window has dealt out and ordered its side for this
    first = F.col("_offset") + F.col("_above") + 1
    return placed.select(*columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias(rank))


def _holder(
    keyed: DataFrame, group: str, wanted: Column, digits: int, labels: Sequence[str]
) -> DataFrame:
    """Per group, the bucket that holds position ``wanted`` and the position inside it."""
    found = (
        _bucket_sizes(keyed, group, digits)
        .withColumn("_need", wanted - F.col("_before"))
        .filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_here")))
        .select(group, F.col("_bucket").alias("_holder"), "_need")
    )
    return of_labels(found, group, labels)


def key_cutoff(
    df: DataFrame,
    group: str,
    text: str,
    seed: int,
    wanted: Column,
    labels: Sequence[str] = CODES,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Per group, the (md5 key, text) of the row at position ``wanted``.

    ``wanted`` may use ``_total``, the rows in the group. Bucket counts locate the
    bucket that holds the position; only that bucket's texts are ordered, with counts
    of their copies.
    """
    keyed = df.select(listed(group, labels).alias(group), text, sample_key(text, seed).alias("_key"))
    holder = _holder(keyed, group, wanted, digits, labels)
    inside = keyed.join(F.broadcast(holder), group).filter(F.left("_key", F.lit(digits)) == F.col("_holder"))
    copies = inside.groupBy(group, "_need", "_key", text).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(group).orderBy("_key", text).rowsBetween(Window.unboundedPreceding, 0))
    return (
        copies.withColumn("_upto", upto)
        .filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
        .select(group, F.struct(F.col("_key"), F.col(text).alias("_text")).alias("_cut"))
    )


def first_by_key(
    df: DataFrame, group: str, text: str, seed: int, k: int, labels: Sequence[str] = CODES, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """The ``k`` rows of each group with the smallest (md5 key, text).

    Rows beyond the key bucket that holds position ``k`` are dropped where they are
    read. Earlier buckets are kept whole and only the last one is cut, so no step
    gathers a group, however large ``k`` is. At most ``k`` rows per bucket leave a map
    task, which also covers many copies of one text.
    """
    bucket = F.left("_key", F.lit(digits))
    keyed = df.withColumn("_key", sample_key(text, seed))
    holder = _holder(keyed, group, F.lit(k), digits, labels)
    near = (
        per_label(keyed, holder, group, labels)
        .filter(F.col("_holder").isNull() | (bucket <= F.col("_holder")))
        .withColumn("_bucket", bucket)
    )
    cut = top_k(near, [group, "_bucket"], ["_key", text], k)
    rank = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy("_key", text))
    kept = F.col("_holder").isNull() | (F.col("_bucket") < F.col("_holder")) | (F.col("_rank") <= F.col("_need"))
    return cut.withColumn("_rank", rank).filter(kept).drop("_key", "_bucket", "_holder", "_need", "_rank")
