"""When shards were active, and when they fell silent.

Events of one shard less than ``gap`` apart belong together.  Two events in the
same bucket of width ``gap`` always do, so events are first reduced to one row
per shard and bucket (on the map side, before any shuffle).  The windows below
then see at most one row per shard and bucket, however hot the shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.functions.measures import micros_between, seconds
from shardbrook.operators.counters import with_lag
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store

DEFAULT_LEASE_SECONDS = 30


def stalled_shards(
    records: DataFrame, as_of: Column | None = None, lease_seconds: int = DEFAULT_LEASE_SECONDS
) -> DataFrame:
    """Shards silent for longer than the lease at ``as_of``.

    Without ``as_of`` the newest record of the shard's own stream is taken.
    """
    newest = records.groupBy(*SHARD_KEYS).agg(F.max("arrival_ts").alias("last_arrival"))
    if as_of is None:
        silent = with_lag(newest).withColumnRenamed("lag_us", "silent_us")
    else:
        silent = newest.withColumn("silent_us", micros_between(F.col("last_arrival"), as_of))
    return silent.filter(F.col("silent_us") > lease_seconds * 1_000_000)


def _buckets(records: DataFrame, gap_seconds: int) -> DataFrame:
    return (
        records.withColumn("_bucket", F.window("arrival_ts", f"{gap_seconds} seconds").start)
        .groupBy(*SHARD_KEYS, "_bucket")
        .agg(
            F.min("arrival_ts").alias("first_ts"),
            F.max("arrival_ts").alias("last_ts"),
            F.count("*").alias("n_records"),
        )
    )


def silence_gaps(records: DataFrame, gap_seconds: int = DEFAULT_LEASE_SECONDS) -> DataFrame:
    """Every stretch longer than ``gap_seconds`` between neighbours in a shard."""
    by_time = Window.partitionBy(*SHARD_KEYS).orderBy("_bucket")
    return (
        _buckets(records, gap_seconds)
        .withColumn("silent_from", F.lag("last_ts").over(by_time))
        .filter(F.col("first_ts") > F.col("silent_from") + seconds(gap_seconds))
        .select(
            *SHARD_KEYS,
            "silent_from",
            F.col("first_ts").alias("silent_until"),
            micros_between(F.col("silent_from"), F.col("first_ts")).alias("gap_us"),
        )
    )


def activity_sessions(records: DataFrame, gap_seconds: int = DEFAULT_LEASE_SECONDS) -> DataFrame:
    """Stretches of activity whose inner gaps are at most ``gap_seconds``.

    Equals a session window; ``session_end`` is the last event plus the gap.
    """
    by_time = Window.partitionBy(*SHARD_KEYS).orderBy("_bucket")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("last_ts").over(by_time)
    opens = previous.isNull() | (F.col("first_ts") > previous + seconds(gap_seconds))
    return (
        _buckets(records, gap_seconds)
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_session", F.sum("_opens").over(so_far))
        .groupBy(*SHARD_KEYS, "_session")
        .agg(
            F.min("first_ts").alias("session_start"),
            (F.max("last_ts") + seconds(gap_seconds)).alias("session_end"),
            F.sum("n_records").alias("n_records"),
        )
        .drop("_session")
    )


def stalls(records: DataFrame, lease_seconds: int = DEFAULT_LEASE_SECONDS) -> DataFrame:
    """Every time a shard was silent for longer than the lease: ``kind, last_arrival, at``.

    ``stalled`` at the end of the lease, up to the newest record of the shard's stream;
    ``back`` at the first record after it.
    """
    # A row per shard and stretch of activity, stored as it meets the tips of its streams.
    opened = store(activity_sessions(records, lease_seconds), "sessions")
    by_time = Window.partitionBy(*SHARD_KEYS).orderBy("session_start")
    tips = opened.groupBy("stream").agg(F.max("session_end").alias("_tip"))
    ended = (
        opened.withColumn("_back", F.lead("session_start").over(by_time))
        .join(tips, "stream")
        .withColumn("last_arrival", F.col("session_end") - seconds(lease_seconds))
        .filter(F.col("session_end") < F.col("_tip") - seconds(lease_seconds))
    )
    told = F.struct(F.lit("stalled").alias("kind"), F.col("session_end").alias("at"))
    back = F.struct(F.lit("back").alias("kind"), F.col("_back").alias("at"))
    kinds = F.when(F.col("_back").isNull(), F.array(told)).otherwise(F.array(told, back))
    return ended.select(*SHARD_KEYS, "last_arrival", F.inline(kinds))
