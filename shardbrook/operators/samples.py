"""Statistics over observed values (lag, fetch time, process time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.functions.measures import seconds, statistic_set, window_bounds
from shardbrook.schema import SHARD_KEYS

# The default histogram boundaries of the Prometheus clients.
DEFAULT_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def sample_stats(samples: DataFrame, interval: str | None = None) -> DataFrame:
    """Count, sum, max, min per shard and metric, and per interval if given."""
    keys: list[Column | str] = [*SHARD_KEYS, "metric"]
    if interval:
        keys.append(F.window("ts", interval).alias("w"))
    stats = samples.groupBy(*keys).agg(*statistic_set("value"))
    return window_bounds(stats) if interval else stats


def sample_stats_dense(shards: DataFrame, samples: DataFrame, interval_seconds: int) -> DataFrame:
    """``sample_stats`` of one metric, with zeros where a shard was silent.

    Every shard covers all intervals between the first and the last sample of the
    whole input.  Silent intervals that follow one another are one row, from the
    start of the first to the end of the last, so a quiet shard costs one row and
    not one for each interval.  Where there is no sample at all each shard has one
    row of zeros without bounds.
    """
    width = f"{interval_seconds} seconds"
    names = ["sample_count", "sum", "maximum", "minimum"]
    keys = shards.select(*SHARD_KEYS).distinct()
    per_window = window_bounds(
        samples.groupBy(F.window("ts", width).alias("w"), *SHARD_KEYS).agg(*statistic_set("value"))
    )
    first = per_window.agg(F.min("window_start")).scalar()
    last = per_window.agg(F.max("window_end")).scalar()
    known = per_window.join(keys, SHARD_KEYS, "left_semi")
    zeros = [F.lit(0).cast("bigint").alias(names[0]), *(F.lit(0.0).alias(n) for n in names[1:])]
    in_time = Window.partitionBy(*SHARD_KEYS).orderBy("window_start")
    silent_before = (
        known.withColumn("_from", F.coalesce(F.lag("window_end").over(in_time), first))
        .filter(F.col("_from") < F.col("window_start"))
        .select(
            F.col("_from").alias("window_start"),
            F.col("window_start").alias("window_end"),
            *SHARD_KEYS,
            *zeros,
        )
    )
    ends = known.groupBy(*SHARD_KEYS).agg(F.max("window_end").alias("_till"))
    silent_after = (
        keys.join(ends, SHARD_KEYS, "left")
        .select(
            F.coalesce("_till", first).alias("window_start"),
            last.alias("window_end"),
            *SHARD_KEYS,
            *zeros,
        )
        .filter(F.col("window_end").isNull() | (F.col("window_start") < F.col("window_end")))
    )
    return (
        known.select("window_start", "window_end", *SHARD_KEYS, *names)
        .unionByName(silent_before)
        .unionByName(silent_after)
    )


def sample_stats_every(samples: DataFrame, interval_seconds: int) -> DataFrame:
    """``sample_stats`` of one metric, a row for every interval since a shard's first row.

    Rows without a value make a shard known and count as no sample.  Silent intervals have
    zeros; all shards go up to the last interval of the whole input.
    """
    width = f"{interval_seconds} seconds"
    names = ["sample_count", "sum", "maximum", "minimum"]
    per_window = window_bounds(
        samples.groupBy(F.window("ts", width).alias("w"), *SHARD_KEYS).agg(*statistic_set("value"))
    )
    last = per_window.agg(F.max("window_end")).scalar()
    in_time = Window.partitionBy(*SHARD_KEYS).orderBy("window_start")
    step = seconds(interval_seconds)
    silent = (
        per_window.withColumn("_next", F.coalesce(F.lead("window_start").over(in_time), last))
        .filter(F.col("window_end") < F.col("_next"))
        .select(
            F.explode(F.sequence("window_end", F.col("_next") - step, step)).alias("window_start"),
            *SHARD_KEYS,
        )
    )
    zeros = [F.lit(0).cast("bigint").alias(names[0]), *(F.lit(0.0).alias(n) for n in names[1:])]
    silent = silent.select(
        "window_start", (F.col("window_start") + step).alias("window_end"), *SHARD_KEYS, *zeros
    )
    return per_window.select("window_start", "window_end", *SHARD_KEYS, *names).unionByName(silent)


def sample_histogram(
    samples: DataFrame, boundaries: Sequence[float] = DEFAULT_BUCKETS
) -> DataFrame:
    """Cumulative counts of values at or below each boundary, plus +Inf.

    One pass with one counter per boundary; rows are spread out after the
    aggregation.  Also carries the total count and sum of the group.
    """
    edges = sorted(set(float(b) for b in boundaries))
    counters = [F.count_if(F.col("value") <= e) for e in edges] + [F.count("value")]
    wide = samples.groupBy(*SHARD_KEYS, "metric").agg(
        F.count("value").alias("sample_count"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("sample_sum"),
        *[c.alias(f"_c{i}") for i, c in enumerate(counters)],
    )
    buckets = [
        F.struct(F.lit(e).alias("le"), F.col(f"_c{i}").alias("cum_count"))
        for i, e in enumerate([*edges, float("inf")])
    ]
    return wide.select(
        *SHARD_KEYS, "metric", "sample_count", "sample_sum", F.inline(F.array(*buckets))
    )
