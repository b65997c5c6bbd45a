"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.sources.scratch import discard, scratch, stored


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum: equal for equal sets of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _lowest(pairs: DataFrame, key: str, value: str) -> tuple[DataFrame, str]:
    """The smallest partner of each node, stored so that a join with it can split hot nodes."""
    path = scratch(pairs.sparkSession, "star-min")
    return stored(pairs.groupBy(key).agg(F.min(value).alias("low")), "", path), path


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; ``root`` is the smallest node that it reaches.

    ``edges`` has integer columns ``a`` and ``b``, in either order, repeats and loops allowed. Each round
    links the larger neighbours of every node to its smallest one, then the node and its
    smaller neighbours likewise; the number of rounds grows with the logarithm of the longest path.
    Neighbours are never gathered in one place: minima are added up before the shuffle, and both
    sides of each join are plain shuffles, which adaptive execution splits where a node is hot.
    Every half-round is written to the shared folder; only a count and a checksum reach the driver.
    """
    spark = edges.sparkSession
    path = scratch(spark, "star")
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "", path)
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, low_path = _lowest(both, "u", "v")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
        large_path = scratch(spark, "star")
        large = stored(large.filter("u <> v").distinct(), "", large_path)
        low2, low2_path = _lowest(large, "u", "v")
        joined = large.join(low2, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small_path = scratch(spark, "star")
        small = stored(joined.unionByName(low2.select("u", F.col("low").alias("v"))).distinct(), "", small_path)
        then, mark = mark, _mark(small)
        for old in (path, low_path, large_path, low2_path):
            discard(spark, old)
        now, path = small, small_path
        if mark == then:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
