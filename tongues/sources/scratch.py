"""The shared folder for intermediate data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else a folder that every executor is sure to see.

    Without the setting that is the session's default file system when it is a shared
    one, and the warehouse when the session runs on a single machine. A cluster with
    neither has no place for intermediate data, which is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not default.startswith("file:"):
        return f"{default.rstrip('/')}/tmp/tongues"
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder of its own below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, so that its lineage ends there."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete intermediate data that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder and continue from there.

    Fitting runs hundreds of jobs on the same few rows; without the cut each of them
    would plan, and describe, everything that led to those rows.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
