"""Fetch, process and lag samples of every batch of a hand-off, per shard.

Which shards a batch held is written by Spark as the batch runs; how long it took
and its newest record are appended when it ends, by a listener.  Only the latter, one row
a batch, passes through the driver; ``batch_samples`` brings both together.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shardbrook.functions.measures import micros_between
from shardbrook.operators.intervals import FETCH, LAG, PROCESS
from shardbrook.schema import SAMPLE, SHARD_KEYS

_OBSERVED = "handoff"
_TIMES = "batch_id bigint, ts timestamp, newest timestamp, fetch_ms bigint, process_ms bigint"
_SHARDS = "stream string, shard_id string, last_arrival timestamp, batch_id bigint"


class BatchTimes(StreamingQueryListener):
    """Appends a row of times for each batch of one query as it ends.

    Give it to ``start_handoff`` and ``close`` it after the query has ended.  A row that
    could not be written is kept and written with the next one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.name = f"handoff-{uuid.uuid4().hex}"
        self.query_id, self.waiting = None, []
        self.ended = threading.Event()
        spark.streams.addListener(self)

    def observed(self, records: DataFrame) -> DataFrame:
        """The same records; a maximum stays right when a batch is read more than once."""
        return records.observe(_OBSERVED, F.max("arrival_ts").alias("newest"))

    def add_shards(self, batch: DataFrame, batch_id: int) -> None:
        """Write which shards a batch holds; a replay writes the same again."""
        found = batch.groupBy(*SHARD_KEYS).agg(F.max("arrival_ts").alias("last_arrival"))
        found.write.mode("overwrite").parquet(f"{self.path}/shards/batch_id={batch_id}")

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.query_id = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        took = progress.durationMs
        if progress.id != self.query_id or "addBatch" not in took:
            return
        seen = progress.observedMetrics.get(_OBSERVED)
        self.waiting.append(
            (
                progress.batchId,
                progress.timestamp,
                seen["newest"] if seen else None,
                took["triggerExecution"],
                took["addBatch"],
            )
        )
        told = _TIMES.replace("ts timestamp", "ts string", 1)
        rows = self.spark.createDataFrame(self.waiting, told).coalesce(1)
        rows.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(
            f"{self.path}/times"
        )
        self.waiting = []

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.query_id:
            self.ended.set()

    def close(self, timeout: float = 60.0) -> None:
        """Wait until the ended query's last batch is written, and listen no more."""
        if self.query_id is not None:
            self.ended.wait(timeout)
        self.spark.streams.removeListener(self)


def batch_samples(spark: SparkSession, path: str) -> DataFrame:
    """SAMPLE rows of all batches: three for each shard that a batch held.

    ``fetch`` is fetching plus processing, ``process`` the user code and its output, both in
    whole milliseconds and of the whole batch; ``lag`` is how far the shard's newest record
    is behind the batch's.  A batch that ran twice has its times twice.
    """
    times = spark.read.schema(_TIMES).parquet(f"{path.rstrip('/')}/times")
    shards = spark.read.schema(_SHARDS).parquet(f"{path.rstrip('/')}/shards")
    behind = F.floor(micros_between(F.col("last_arrival"), F.col("newest")) / 1000)
    values = F.array(
        *(
            F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))
            for metric, value in (
                (FETCH, F.col("fetch_ms")),
                (PROCESS, F.col("process_ms")),
                (LAG, behind),
            )
        )
    )
    found = shards.join(times, "batch_id").select("stream", "shard_id", "ts", F.inline(values))
    return found.select(*SAMPLE.fieldNames())
