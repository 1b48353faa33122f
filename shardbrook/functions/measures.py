"""Column helpers for metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload_bytes(data: Column | str = "data") -> Column:
    """Payload size in bytes; a missing payload counts as empty."""
    return F.coalesce(F.octet_length(data), F.lit(0)).cast("bigint")


def whole_millis(nanos: Column | str) -> Column:
    """Nanoseconds to whole milliseconds (the fraction is dropped), as double."""
    nanos = F.col(nanos) if isinstance(nanos, str) else nanos
    return F.call_function("div", nanos, F.lit(1_000_000)).cast("double")


def micros_between(earlier: Column, later: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def seconds(n: int) -> Column:
    """A day-time interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n).cast("decimal(18,6)"))


def statistic_set(value: Column | str, prefix: str = "") -> list[Column]:
    """Count, sum, maximum and minimum; all 0 when there is no sample.

    The state is four numbers per group whatever the number of samples.
    """
    return [
        F.count(value).alias(f"{prefix}sample_count"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias(f"{prefix}sum"),
        F.coalesce(F.max(value), F.lit(0.0)).alias(f"{prefix}maximum"),
        F.coalesce(F.min(value), F.lit(0.0)).alias(f"{prefix}minimum"),
    ]


def window_bounds(df: DataFrame, window: str = "w") -> DataFrame:
    """Replace a window column by its two bounds, put first."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *rest,
    )
