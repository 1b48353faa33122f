"""Per-shard totals.  The same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardbrook.functions.measures import micros_between, payload_bytes
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store


def records_processed(records: DataFrame) -> DataFrame:
    return records.groupBy(*SHARD_KEYS).agg(F.count("*").alias("n_records"))


def bytes_processed(records: DataFrame) -> DataFrame:
    return records.groupBy(*SHARD_KEYS).agg(F.sum(payload_bytes()).alias("n_bytes"))


def throughput(records: DataFrame) -> DataFrame:
    """Records, bytes and newest arrival per shard in one pass."""
    return records.groupBy(*SHARD_KEYS).agg(
        F.count("*").alias("n_records"),
        F.sum(payload_bytes()).alias("n_bytes"),
        F.max("arrival_ts").alias("last_arrival"),
    )


def with_lag(per_shard: DataFrame) -> DataFrame:
    """Add how far each shard's newest record is behind the newest of its stream.

    Works on one row per shard, stored so that the log is scanned once; each meets the one
    row of its stream.  A shard without a stream has no lag.
    """
    per_shard = store(per_shard, "per-shard")
    tips = per_shard.groupBy("stream").agg(F.max("last_arrival").alias("_tip"))
    return per_shard.join(tips, "stream", "left").withColumn(
        "lag_us", micros_between(F.col("last_arrival"), F.col("_tip"))
    ).select(*per_shard.columns, "lag_us")


def lag_gauge(samples: DataFrame, metric: str = "lag") -> DataFrame:
    """The newest sample of each shard: ``value`` and when it was taken.

    Of several at one time the largest counts.  Samples without a time are left out.
    """
    own = samples.filter((F.col("metric") == metric) & F.col("ts").isNotNull())
    newest = F.max(F.struct("ts", "value"))
    return own.groupBy(*SHARD_KEYS).agg(newest.alias("_s")).select(
        *SHARD_KEYS, F.col("_s.ts").alias("ts"), F.col("_s.value").alias("value")
    )


def lag_latest(records: DataFrame) -> DataFrame:
    """The lag gauge: microseconds behind the stream's tip, per shard."""
    newest = records.groupBy(*SHARD_KEYS).agg(F.max("arrival_ts").alias("last_arrival"))
    return with_lag(newest)


def event_counts(lease_events: DataFrame, kind: str = "renewed") -> DataFrame:
    """Count one kind of lease event; shards and workers without any show 0."""
    return lease_events.groupBy(*SHARD_KEYS, "worker").agg(
        F.count_if(F.col("kind") == kind).alias("n_events")
    )
