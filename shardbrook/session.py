"""Session settings this package is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Advice for a cluster session; every value can be overridden there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Push a min/max found by a subquery into the Parquet scan.
    "spark.sql.parquet.filterPushdown": "true",
    # Merge a task's own sessions before they are shuffled, so a hot shard is
    # reduced on the map side.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Keep streaming state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "shardbrook", master: str | None = None, **conf: str
) -> SparkSession:
    """Start (or reuse) a session; ``conf`` takes names with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()
