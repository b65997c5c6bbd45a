"""Intermediate tables whose shuffle files go as soon as the table is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tongues.sources.scratch import discard, scratch, stored

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Interim:
    """Tables of one job in the shared folder, by name; ``drop`` deletes what nothing reads any more.

    A written table needs the shuffles that led to it no longer, so they are cleaned up with
    the write; without that they fill the executors' disks until the driver happens to collect its garbage.
    """

    def __init__(self, job: str):
        self.job, self.paths = job, {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        self.paths[name] = path = scratch(spark, f"{self.job}-{name}")
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            return stored(df, "", path)
        finally:
            if before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)

    def drop(self, spark, *names: str) -> None:
        for name in names:
            discard(spark, self.paths.pop(name))
