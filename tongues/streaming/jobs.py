"""Detecting and collecting sentences as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tongues.config import CorpusConfig
from tongues.model.detector import Detector
from tongues.operators.sentences import document_sentences

SALTS = 16
_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_detect(texts: DataFrame, detector: Detector, text: str = "text", top_n: int = 2) -> DataFrame:
    """Detection of every incoming text. Stateless, the same columns as in batch."""
    return detector.detect(texts, text, top_n)


def unseen(rows: DataFrame, salt: Column, ingest_time: str | None = None, within: str = "7 days", keep_for: str | None = None) -> DataFrame:
    """``(language, text)`` of the sentences that did not come before in the stream.

    A sentence repeated in a third of all rows first meets its copies in one of
    ``SALTS`` groups, chosen by ``salt``, so that no single task sees them all. State holds two 64-bit hashes of a sentence,
    never its text. It grows with the distinct sentences, unless it may forget: with ``ingest_time``, a timestamp
    column, those older than ``within`` when the column's time has passed on; with ``keep_for``, those that first came so long ago by
    the clock of the stream, which needs no time in the data. A forgotten sentence counts as new when it comes again.
    """
    keys = [F.xxhash64("language", "text").alias("_h1"), F.xxhash64(F.lit(7), "language", "text").alias("_h2")]
    salted = F.pmod(salt, F.lit(SALTS)).alias("_salt")
    if ingest_time is None and keep_for is None:
        rows = rows.select("language", "text", *keys, salted)
        return rows.dropDuplicates(["_h1", "_h2", "_salt"]).dropDuplicates(["_h1", "_h2"]).select("language", "text")
    time = F.col(ingest_time) if ingest_time else F.current_timestamp()
    rows = rows.select("language", "text", *keys, salted, time.alias("_time")).withWatermark("_time", within if ingest_time else keep_for)
    rows = rows.dropDuplicatesWithinWatermark(["_h1", "_h2", "_salt"]).dropDuplicatesWithinWatermark(["_h1", "_h2"])
    return rows.select("language", "text", *([F.col("_time").alias(ingest_time)] if ingest_time else []))


def stream_new_sentences(
    documents: DataFrame,
    source: str = "doc_id",
    config: CorpusConfig = CorpusConfig(),
    ingest_time: str | None = None,
    within: str = "7 days",
    tasks: int | None = None,
    keep_for: str | None = None,
) -> DataFrame:
    """Clean sentences of documents not seen before in the stream, as ``(language, text)``.

    See ``unseen`` for what state is kept and forgotten. Use ``run_available`` with its default state store for large streams.
    ``tasks`` spreads documents first, for sources that arrive in fewer splits than cores.
    """
    if tasks:
        documents = documents.repartition(tasks, source)
    time = [ingest_time] if ingest_time else []
    clean = document_sentences(documents.select(source, *time, "language", "text"), config)
    return unseen(clean, F.xxhash64(source), ingest_time, within, keep_for)


def run_available(stream: DataFrame, output: str, checkpoint: str, fmt: str = "parquet", store: str | None = ROCKSDB) -> StreamingQuery:
    """Process everything there is, append it to ``output`` and stop.

    State is kept by ``store``, a provider class; the default keeps it on local disks and in the checkpoint instead of in
    memory. A checkpoint remembers its own, and None takes that of the session.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_STORE, None)
    if store:
        spark.conf.set(_STORE, store)
    try:
        query = (
            stream.writeStream.format(fmt)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(output)
        )
    finally:
        if store and before is not None:
            spark.conf.set(_STORE, before)
        elif store:
            spark.conf.unset(_STORE)
    query.awaitTermination()
    return query


def read_available(spark: SparkSession, output: str, schema: StructType) -> DataFrame:
    """What ``run_available`` has appended to ``output`` as Parquet; no rows where the stream had none so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(output)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(output)
