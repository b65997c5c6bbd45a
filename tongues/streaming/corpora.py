"""Corpora that grow with a stream of pages, micro-batch by micro-batch.

State is folders of files, one for each micro-batch. What a batch adds depends on the folders of earlier batches
alone, and it replaces its own, so a batch that is run again after a failure gives the same.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tongues.config import CorpusConfig
from tongues.operators.pages import page_records, rule_bits, rule_texts
from tongues.operators.sentences import clean_sentences
from tongues.operators.sets import KEY, capped_corpus, new_sentences
from tongues.sources.dims import CODES
from tongues.sources.scratch import discard


class Folders:
    """Rows of ``schema`` in a folder for each micro-batch."""

    def __init__(self, spark: SparkSession, directory: str, schema: str):
        self.spark, self.directory, self.schema = spark, directory.rstrip("/"), schema

    def _status(self) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.directory)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return list(files.listStatus(path)) if files.exists(path) else []

    def batches(self) -> list[int]:
        names = [s.getPath().getName() for s in self._status()]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches with a smaller number."""
        if not self.batches():
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, batch long").parquet(self.directory)
        return (rows if before is None else rows.filter(F.col("batch") < before)).drop("batch")

    def write(self, rows: DataFrame, batch: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.directory}/batch={batch}")
        return self.spark.read.schema(self.schema).parquet(f"{self.directory}/batch={batch}")

    def drop(self, batch: int) -> None:
        discard(self.spark, f"{self.directory}/batch={batch}")


def _absorbing(stream: DataFrame, absorb: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class CappedCorpus:
    """The sentences of the first pages of each language, until there are ``cap`` of them, over many micro-batches.

    Its state is the corpus itself. Pages must come whole and in ascending order of ``order``, those of a batch in any order;
    then the corpus equals that of all pages at once.
    """

    def __init__(
        self, spark: SparkSession, directory: str, cap: int = CorpusConfig().max_sentences_per_language,
        order: str = "page_order", languages: Sequence[str] = CODES,
    ):
        self.cap, self.order, self.languages = cap, order, tuple(languages)
        self.found = Folders(spark, directory, "language string, text string")

    def read(self) -> DataFrame:
        return self.found.read()

    def absorb(self, pages: DataFrame, batch: int) -> None:
        """Add the sentences of a batch; ``pages`` has ``language, text`` and the order of the page.

        Languages that have enough are dropped where they are read. The counts of the others, one for each listed
        language, start the count of the batch's pages.
        """
        known = self.found.read(batch)
        counts = {r["language"]: r["n"] for r in known.groupBy("language").agg(F.count("*").alias("n")).collect()}
        lacking = [code for code in self.languages if counts.get(code, 0) < self.cap]
        rows = pages.filter(F.col("language").isin(lacking)).groupBy(*KEY).agg(F.min(self.order).alias(self.order))
        fresh = new_sentences(rows, known, keep=[self.order])
        self.found.write(capped_corpus(fresh, self.cap, self.order, self.languages, {c: counts[c] for c in lacking if c in counts}), batch)

    def start(self, pages: DataFrame, checkpoint: str) -> StreamingQuery:
        """Absorb everything that the stream ``pages`` has and stop."""
        return _absorbing(pages, self.absorb, checkpoint)


class PageCorpus:
    """Sentences of pages that did not come before, over many micro-batches; of an address one snapshot counts.

    That is the one that came first, and of those in one batch that of the smallest ``page_id``. Pages are parsed where they are read, and what is
    shuffled is their sentences; snapshots of an address in a third of all rows meet after partial minima. State is two 64-bit hashes of
    each address and each sentence. It grows with them, unless ``keep_for`` seconds are given: then folders that are older by the clock are
    dropped, and what they held counts as new when it comes again. The sentences found are in ``directory/sentences``.
    """

    def __init__(
        self, spark: SparkSession, directory: str, rules: DataFrame, config: CorpusConfig = CorpusConfig(),
        keep_for: float | None = None, tasks: int | None = None, clock: Callable[[], float] = time.time,
    ):
        self.distinct, self.bits = rule_bits(rules)
        self.config, self.keep_for, self.tasks, self.clock = config, keep_for, tasks, clock
        state = "h1 long, h2 long, at double"
        self.addresses, self.seen = Folders(spark, f"{directory}/addresses", state), Folders(spark, f"{directory}/seen", state)
        self.pages = Folders(spark, f"{directory}/pages", "page_id long, url string, language string, found array<string>")
        self.sentences = Folders(spark, f"{directory}/sentences", "language string, text string")

    def read(self) -> DataFrame:
        """``(language, text)`` found so far."""
        return self.sentences.read()

    def _known(self, state: Folders, batch: int, now: float) -> DataFrame:
        rows = state.read(batch)
        return (rows if self.keep_for is None else rows.filter(F.col("at") >= now - self.keep_for)).select("h1", "h2").distinct()

    def _forget(self, state: Folders, batch: int, now: float) -> None:
        """Drop the folders that are too old for this batch and all later ones."""
        if self.keep_for is not None:
            rows = state.spark.read.schema(f"{state.schema}, batch long").parquet(state.directory)
            young = {r["batch"] for r in rows.filter(F.col("at") >= now - self.keep_for).select("batch").distinct().collect()}
            for old in state.batches():
                if old < batch and old not in young:
                    state.drop(old)

    def absorb(self, pages: DataFrame, batch: int) -> None:
        """Add the new sentences of a batch; ``pages`` has ``page_id, url, language, html``."""
        now = self.clock()
        pages = pages.filter(F.col("html") != "").select("page_id", "url", "language", "html")
        if self.tasks:
            pages = pages.repartition(self.tasks, "page_id")
        records = page_records(pages, self.distinct, ("page_id", "url", "language"), self.config)
        rows = records.select("page_id", "url", "language", rule_texts(self.bits).alias("found"))
        first = rows.groupBy("url").agg(F.min_by(F.struct("page_id", "language", "found"), "page_id").alias("_first"))
        first = first.select("_first.page_id", "url", "_first.language", "_first.found")
        known = self._known(self.addresses, batch, now)
        fresh = first.withColumns(_hashes("url")).join(known, ["h1", "h2"], "left_anti")
        fresh = self.pages.write(fresh.select("page_id", "url", "language", "found"), batch)
        self.addresses.write(fresh.select(*[v.alias(k) for k, v in _hashes("url").items()], F.lit(now).alias("at")), batch)
        said = clean_sentences(fresh.select("language", F.explode("found").alias("text")), self.config).select(*KEY).distinct()
        known = self._known(self.seen, batch, now)
        said = self.sentences.write(said.withColumns(_hashes(*KEY)).join(known, ["h1", "h2"], "left_anti").select(*KEY), batch)
        self.seen.write(said.select(*[v.alias(k) for k, v in _hashes(*KEY).items()], F.lit(now).alias("at")), batch)
        for state in (self.addresses, self.seen):
            self._forget(state, batch, now)

    def start(self, pages: DataFrame, checkpoint: str) -> StreamingQuery:
        """Absorb everything that the stream ``pages`` has and stop."""
        return _absorbing(pages, self.absorb, checkpoint)


def _hashes(*columns: str) -> dict:
    return {"h1": F.xxhash64(*columns), "h2": F.xxhash64(F.lit(7), *columns)}
