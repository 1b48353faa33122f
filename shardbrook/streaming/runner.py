"""Start and finish streaming queries."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shardbrook.session import SETTINGS


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for a query that is started inside, unless the session names a store.

    Spark's default store has no keyed state with timers.  A query keeps the settings it
    was started with, so the session's are as before afterwards.
    """
    if spark.conf.get(_PROVIDER, ""):
        yield
        return
    spark.conf.set(_PROVIDER, SETTINGS[_PROVIDER])
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER)


def start(
    writer: DataStreamWriter, checkpoint: str, spark: SparkSession | None = None, **trigger
) -> StreamingQuery:
    """Start a query; without a trigger it reads what is there and ends."""
    trigger = trigger or {"availableNow": True}
    with _state_store(spark or SparkSession.active()):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; its failure is raised here."""
    query.awaitTermination()
    return query


def after_batch(query: StreamingQuery) -> None:
    """Wait until a query has finished a batch; its failure is raised here."""
    while query.isActive and query.lastProgress is None:
        time.sleep(0.05)
    if query.exception() is not None:
        raise query.exception()


def stop(query: StreamingQuery) -> None:
    """Let the batch in progress finish, then stop, whether or not data keeps coming."""
    before = query.lastProgress
    while query.isActive and query.status["isTriggerActive"]:
        now = query.lastProgress
        if now is not None and (before is None or now["batchId"] != before["batchId"]):
            break
        time.sleep(0.05)
    query.stop()


def append_to_table(
    result: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append a stream's final rows to Parquet, each exactly once."""
    writer = result.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer, checkpoint, result.sparkSession, **trigger)


def keep_newest(
    result: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Keep the whole current result of a ``complete`` aggregation at ``path``.

    Two folders are written in turn, so one always holds a finished result.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/turn={batch_id % 2}")

    writer = result.writeStream.outputMode("complete").foreachBatch(replace)
    return start(writer, checkpoint, result.sparkSession, **trigger)


def read_newest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``keep_newest`` wrote last."""
    both = spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.LongType())]))
    rows = both.parquet(path)
    newest = rows.agg(F.max("_batch")).scalar()
    return rows.filter(F.col("_batch") == newest).select(*schema.fieldNames())
