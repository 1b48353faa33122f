"""The periodic flush: what happened per shard in each interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.functions.measures import payload_bytes, window_bounds
from shardbrook.operators.counters import throughput
from shardbrook.operators.running import lease_changes
from shardbrook.operators.samples import sample_stats
from shardbrook.schema import SHARD_KEYS

DEFAULT_INTERVAL = "60 seconds"

# Sample metrics, as found in SAMPLE.metric.
LAG, FETCH, PROCESS = "lag", "fetch", "process"
_RECORD = "record"


def throughput_by_interval(records: DataFrame, interval: str = DEFAULT_INTERVAL) -> DataFrame:
    """Records and bytes per interval.  Counts restart with each interval."""
    grouped = records.groupBy(F.window("arrival_ts", interval).alias("w"), *SHARD_KEYS)
    return window_bounds(
        grouped.agg(
            F.count("*").alias("n_records"), F.sum(payload_bytes()).alias("n_bytes")
        )
    )


def untimed_records(records: DataFrame) -> DataFrame:
    """How many records of each shard have no time, beside all of them.

    They count in totals and stand in no interval, session or stream.
    """
    return records.groupBy(*SHARD_KEYS).agg(
        F.count_if(F.col("arrival_ts").isNull()).alias("n_untimed"), F.count("*").alias("n_records")
    )


def shard_metrics(
    records: DataFrame, samples: DataFrame, interval: str | None = DEFAULT_INTERVAL
) -> DataFrame:
    """All per-shard metrics of each interval side by side.

    With ``interval=None`` one row per shard over everything (cumulative form).
    Records and samples are each reduced to one row per shard, interval and
    metric; only those few rows are brought together and spread into columns.
    """
    keys = [*(["window_start", "window_end"] if interval else []), *SHARD_KEYS]
    if interval:
        counts = throughput_by_interval(records, interval)
    else:
        counts = throughput(records)
    together = record_columns(counts, keys).unionByName(
        sample_columns(sample_stats(samples, interval), keys)
    )
    return together.groupBy(*keys).agg(*metric_columns())


_STATS = ("sample_count", "sum", "maximum", "minimum")


def record_columns(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of records in the columns that they share with statistics of samples."""
    return counts.select(
        *keys,
        F.lit(_RECORD).alias("metric"),
        F.col("n_records").alias("sample_count"),
        "n_bytes",
        F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("maximum"),
        F.lit(0.0).alias("minimum"),
    )


def sample_columns(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stats.select(*keys, "metric", *_STATS, F.lit(0).cast("bigint").alias("n_bytes"))


def metric_columns() -> list[Column]:
    """Aggregates that spread rows per metric into columns."""

    def of(metric: str, column: str) -> Column:
        return F.coalesce(
            F.max(F.when(F.col("metric") == metric, F.col(column))), F.lit(0)
        )

    return [
        of(_RECORD, "sample_count").cast("bigint").alias("n_records"),
        F.max("n_bytes").alias("n_bytes"),
        *[of(m, s).alias(f"{m}_{s}") for m in (LAG, FETCH, PROCESS) for s in _STATS],
    ]


def lease_sums(net: str) -> list[Column]:
    """Renewals, and gains less losses under the name ``net``."""
    return [
        F.count_if(F.col("kind") == "renewed").alias("n_renewals"),
        F.sum(lease_changes()).alias(net),
    ]


def lease_metrics(lease_events: DataFrame, interval: str | None = DEFAULT_INTERVAL) -> DataFrame:
    """Renewals per interval, and leases held at its end (never reset)."""
    keys = [*SHARD_KEYS, "worker"]
    sums = lease_sums("_net")
    if not interval:
        return (
            lease_events.groupBy(*keys).agg(*sums).withColumnRenamed("_net", "leases_held")
        )
    per_window = window_bounds(
        lease_events.groupBy(F.window("ts", interval).alias("w"), *keys).agg(*sums)
    )
    # One row per interval by now, so a hot shard's events are not sorted here.
    so_far = Window.partitionBy(*keys).orderBy("window_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return per_window.withColumn("leases_held", F.sum("_net").over(so_far)).drop("_net")
