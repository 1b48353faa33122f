"""Stream forms of the batch reports.  Event time is ``arrival_ts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardbrook.operators.activity import activity_sessions
from shardbrook.operators.counters import throughput
from shardbrook.operators.delivery import IDENTITY
from shardbrook.operators.intervals import DEFAULT_INTERVAL, throughput_by_interval
from shardbrook.schema import SHARD_KEYS


def stream_throughput_by_interval(
    records: DataFrame, interval: str = DEFAULT_INTERVAL, delay: str = "1 minute"
) -> DataFrame:
    """Interval counts, each emitted once when the watermark passes it."""
    return throughput_by_interval(records.withWatermark("arrival_ts", delay), interval)


def stream_totals(records: DataFrame) -> DataFrame:
    """Counters that never reset; run in ``complete`` or ``update`` mode.

    State is one row per shard.
    """
    return throughput(records)


def stream_sessions(records: DataFrame, gap_seconds: int, delay: str) -> DataFrame:
    """Activity sessions.

    ``session.SETTINGS`` turns on merging inside each task before the shuffle: it
    changes no result, and without it every event of a hot shard is shuffled.
    """
    session = F.session_window("arrival_ts", f"{gap_seconds} seconds")
    return (
        records.withWatermark("arrival_ts", delay)
        .groupBy(*SHARD_KEYS, session.alias("w"))
        .agg(F.count("*").alias("n_records"))
        .select(
            *SHARD_KEYS,
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "n_records",
        )
    )


def final_watermark(query: StreamingQuery) -> Column | None:
    """The watermark an ended query stopped at; None if it never saw a record."""
    progress = query.lastProgress
    value = (progress or {}).get("eventTime", {}).get("watermark")
    return None if value is None else F.lit(value).cast("timestamp")


def open_windows(records: DataFrame, interval: str, watermark: Column | None) -> DataFrame:
    """The end-of-log step of ``stream_throughput_by_interval``.

    A stream gives a window out when its watermark has passed it; the last ones never
    leave when the log ends.  These are the windows that ended after ``watermark``,
    from a batch read of the same log; together with the stream's they are all.
    """
    found = throughput_by_interval(records, interval)
    return found if watermark is None else found.filter(F.col("window_end") > watermark)


def open_sessions(records: DataFrame, gap_seconds: int, watermark: Column | None) -> DataFrame:
    """The end-of-log step of ``stream_sessions``: sessions that end after ``watermark``."""
    found = activity_sessions(records, gap_seconds)
    return found if watermark is None else found.filter(F.col("session_end") > watermark)


def stream_drop_duplicates(
    records: DataFrame, delay: str, hot_copies: bool = True
) -> DataFrame:
    """Drop repeated deliveries that arrive within ``delay`` of each other.

    All copies of a record must meet in one task.  So that a record with very
    many copies does not flood it, copies read by the same task are dropped
    first, wherever they are.  That is a second shuffle and more state; turn it
    off where records come at most a few times.
    """
    rows = records.withWatermark("arrival_ts", delay)
    if hot_copies:
        rows = (
            rows.withColumn("_task", F.spark_partition_id())
            .dropDuplicatesWithinWatermark([*IDENTITY, "_task"])
            .drop("_task")
        )
    return rows.dropDuplicatesWithinWatermark(IDENTITY)
