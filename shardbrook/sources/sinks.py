"""Where metrics go."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_metrics(long: DataFrame, path: str) -> None:
    """Append the long metric table."""
    long.write.mode("append").parquet(path)


def write_exposition(lines: DataFrame, path: str) -> None:
    """Write exposition lines as text files that follow on from each other."""
    order = ["family", "stream", "shard_id", "worker", "part", "le"]
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)
