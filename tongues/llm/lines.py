"""Line dedup against levelled sorted runs of line hashes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.llm.native import BLANKS, ascii_lower, let
from tongues.sources.scratch import discard, scratch, stored

#: Keys shorter than this many code points never lose a line.
MIN_KEY = 10
#: A level with this many runs is merged into one run of the next level.
FANOUT = 2
#: Batches, by range of ``doc_id``, in which a whole table is absorbed.
BATCHES = 3
RUN = "h1 bigint, h2 bigint, owner bigint"
_LAST = 9223372036854775807


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _order() -> Column:
    """Documents by ascending ``doc_id``; null ids come last and count as one document."""
    return F.coalesce(F.col("doc_id"), F.lit(_LAST))


def line_hashes(docs: DataFrame) -> DataFrame:
    """``doc, twin, h1, h2, pos`` of every line whose key is long enough.

    The key is the line stripped of blanks and lower-cased from A to Z, held as two
    64-bit hashes with different seeds. ``twin`` tells texts of a repeated ``doc_id`` apart.
    """
    lines = docs.select(_order().alias("doc"), F.xxhash64(_text()).alias("twin"), F.posexplode(F.split(_text(), "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "twin", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= MIN_KEY)
    return keyed.select("doc", "twin", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "pos")


@contextmanager
def _ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Spark trusts the order of a bucket that is one file only under this setting, and else sorts it again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Which document owns which line: sorted runs of ``h1, h2, owner`` in levels, kept in the shared folder.

    A run is one sorted file for each of ``buckets`` ranges of the hash, so that all comparisons meet the runs where they
    are: only the hashes of a batch are exchanged and sorted. A batch adds one run of the hashes that no earlier run
    has with an owner as small; ``FANOUT`` runs of a level are merged into one of the next, so there are about
    ``log(batches)`` runs to look through. Batches may arrive in any order; where they come by ascending ``doc_id``,
    a hash is in one run only. All state is files, and ``levels`` is their few names: lost executors cost nothing
    but the task at hand, and a later session goes on with the ``levels`` and ``buckets`` of an earlier one.

    ``buckets`` is the session's number of shuffle partitions if not given; another number is right, too, but costs one more exchange
    of the batch. Tables over the runs belong to the session until ``close``.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None, levels: list[list[str]] | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [list(level) for level in levels or []]

    def _paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def runs(self) -> DataFrame | None:
        """All runs as one table, None before the first batch."""
        return self.spark.read.schema(RUN).parquet(*self._paths()) if self._paths() else None

    @staticmethod
    def _name(path: str) -> str:
        return path.rsplit("/", 1)[1].replace("-", "_")

    def _table(self, path: str) -> DataFrame:
        """A run as a table that knows of its buckets and their order."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(path)} ({RUN}) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(self._name(path))

    def _write(self, hashes: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        path = scratch(self.spark, f"line-run-{level}")
        writer = hashes.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", path).saveAsTable(self._name(path))
        self.levels[level].append(path)

    def unknown(self, batch: DataFrame) -> DataFrame:
        """``h1, h2, owner`` of the lines of a batch that no run has with an owner as small."""
        owned = line_hashes(batch).groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
        if self._paths() and int(self.spark.conf.get("spark.sql.shuffle.partitions")) != self.buckets:
            owned = owned.repartition(self.buckets, "h1", "h2")
        for path in self._paths():
            known = self._table(path).withColumnRenamed("owner", "_owner").hint("merge")
            # the comparison of owners also keeps the join above the aggregation, where common lines are one row
            same = (owned["h1"] == known["h1"]) & (owned["h2"] == known["h2"]) & (known["_owner"] <= owned["owner"])
            owned = owned.join(known, same, "left_anti")
        return owned

    def merged(self, paths: list[str]) -> DataFrame:
        """Runs as one, hash by hash, with the smaller owner; two runs meet bucket by bucket, further ones are exchanged."""
        def pair(one: DataFrame, other: DataFrame) -> DataFrame:
            both = one.join(other.withColumnRenamed("owner", "_owner").hint("merge"), ["h1", "h2"], "full")
            return both.select("h1", "h2", F.least("owner", "_owner").alias("owner"))

        return reduce(pair, [self._table(p) for p in paths])

    def absorb(self, batch: DataFrame) -> None:
        """Anti-join a batch's line hashes with the runs, add the new ones as a run, compact."""
        with _ordered_scans(self.spark):
            self._write(self.unknown(batch), 0)
            level = 0
            while len(self.levels[level]) >= self.fanout:
                old = self.levels[level]
                self._write(self.merged(old), level + 1)
                self.levels[level] = []
                for path in old:
                    self._forget(path)
                    discard(self.spark, path)
                level += 1

    def _forget(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(path)}")

    def close(self) -> None:
        """Forget the tables; the files stay, and another batch makes the tables anew."""
        for path in self._paths():
            self._forget(path)

    def dropped(self, docs: DataFrame) -> DataFrame:
        """``doc, twin, drops``: per text the sorted positions of lines that a smaller document owns."""
        lines = line_hashes(docs).join(self.runs(), ["h1", "h2"])
        lost = lines.filter(F.col("owner") < F.col("doc"))
        return lost.groupBy("doc", "twin").agg(F.array_sort(F.collect_set("pos")).alias("drops"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text of the lines that stay.

        The kept lines are the stretches between dropped ones, so the work is linear in the
        lines of a text.
        """
        drops = self.dropped(docs).toDF("_at", "_copy", "_drops")
        keyed = docs.withColumn("_doc", _order()).withColumn("_twin", F.xxhash64(_text()))
        joined = keyed.join(drops, (F.col("_doc") == F.col("_at")) & (F.col("_twin") == F.col("_copy")), "left")

        def between(lines: Column) -> Column:
            edges = F.concat(F.array(F.lit(-1)), F.coalesce(F.col("_drops"), F.array().cast("array<int>")), F.array(F.size(lines)))
            return let(edges, lambda e: F.array_join(F.flatten(F.transform(
                F.sequence(F.lit(1), F.size(e) - 1), lambda i: F.slice(lines, e[i - 1] + 2, e[i] - e[i - 1] - 1)
            )), "\n"))

        kept = F.when(F.col("_drops").isNull(), _text()).otherwise(let(F.split(_text(), "\n", -1), between))
        return joined.select(
            *[docs[c] for c in docs.columns],
            F.size(F.split(_text(), "\n", -1)).cast("long").alias("n_lines"),
            F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"),
            kept.alias("kept"),
        )


def batch_cuts(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut a table into about ``batches`` parts of as many rows each, ascending; none for a table without ids."""
    if batches < 2:
        return []
    found = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0]
    return sorted(set(found or []))


def absorb_table(docs: DataFrame, batches: int = BATCHES) -> LineRuns:
    """Absorb a whole table in ``batches`` ranges of ``doc_id`` with about as many rows each, smallest first; null ids go with the last."""
    runs = LineRuns(docs.sparkSession)
    edges = [None, *batch_cuts(docs, batches), None]
    for start, end in zip(edges, edges[1:]):
        batch = docs
        if start is not None:
            batch = batch.filter((F.col("doc_id") >= start) | F.col("doc_id").isNull() if end is None else F.col("doc_id") >= start)
        if end is not None:
            batch = batch.filter(F.col("doc_id") < end)
        runs.absorb(batch)
    runs.close()
    return runs


def dedup_lines(docs: DataFrame, batches: int = BATCHES, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The columns ``keep``, ``n_lines``, ``n_dropped`` and ``kept`` for every document.

    A line whose key of at least ``MIN_KEY`` code points also stands in a document of smaller
    ``doc_id`` is dropped; other lines stay, repeated ones too. Null and empty texts are one empty
    line. Rows of one ``doc_id`` count as one document and keep each other's lines.
    """
    docs = docs.select(*keep)
    return absorb_table(docs, batches).apply(docs)
