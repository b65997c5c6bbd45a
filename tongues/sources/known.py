"""A corpus of known sentences, stored so that comparing new ones with it moves the new ones only."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tongues.operators.sets import KEY

BUCKETS = 64


class KnownCorpus:
    """Distinct ``(language, text)`` below ``directory``, in ``buckets`` by a hash of ``on``, each file in order of it.

    The files are the corpus; the table over them belongs to the session and is made again by the next. A side with as many
    partitions by the same hash meets the buckets where they are, so the known side is neither exchanged nor read
    further than its keys. Take about as many buckets as tasks are to work on a comparison.
    """

    def __init__(self, spark: SparkSession, directory: str, buckets: int = BUCKETS, on: Sequence[str] = KEY):
        self.spark, self.directory, self.buckets, self.on = spark, directory.rstrip("/"), buckets, list(on)
        self.name = f"known_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{c}`" for c in self.on)
        spark.sql(
            f"CREATE TABLE {self.name} (language STRING, text STRING) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{self.directory}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, sentences: DataFrame) -> None:
        """Add the sentences that are not known yet: one more sorted file in each bucket that gains some."""
        fresh = self.unknown(sentences)
        fresh.repartition(self.buckets, *self.on).select(*KEY).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def unknown(self, sentences: DataFrame) -> DataFrame:
        """``operators.sets.new_sentences``: distinct sentences whose key is not known."""
        left = sentences.select(*KEY).distinct().repartition(self.buckets, *self.on)
        known = self.read().select(*self.on).filter(" AND ".join(f"`{c}` IS NOT NULL" for c in self.on))
        return left.join(known.hint("merge"), self.on, "left_anti").select(*KEY)

    def compact(self) -> KnownCorpus:
        """The same corpus in one file for each bucket, in a folder of its own beside this one."""
        other = KnownCorpus(self.spark, f"{self.directory}-{uuid.uuid4().hex}", self.buckets, self.on)
        # from plain files: over the table Spark takes the exchange for needless and then reads it without its buckets
        plain = self.spark.read.schema("language string, text string").parquet(self.directory)
        plain.repartition(self.buckets, *self.on).write.insertInto(other.name)
        self.spark.catalog.refreshTable(other.name)
        return other

    def files(self) -> int:
        return self.read().select(F.input_file_name()).distinct().count()

    def close(self) -> None:
        """Forget the table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
