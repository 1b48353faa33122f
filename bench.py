"""Time the headline queries.

Prints one JSON line.  Each query runs to a full result that is not kept (Spark's
``noop`` sink); the time is the best of ``BENCH_RUNS`` runs in a warm session.
"""

from __future__ import annotations

import json
import os
import time

from shardbrook.plans.queries import QUERIES
from shardbrook.session import build_session

HEADLINE = [
    "shard_summary",
    "metrics_windowed",
    "metrics_hourly",
    "metrics_long",
    "resume_after_checkpoint",
    "checkpoint_latest",
    "checkpoint_upsert",
    "shard_drained",
    "duplicate_deliveries",
    "duration_stats",
    "duration_histogram",
    "running_gauge",
    "silence_gaps",
    "activity_sessions",
    "owner_skew_by_bytes",
    "handoff_ordered",
    "handoff_batch",
    "stream_windows",
    "shard_positions",
    "deduplicated_deliveries",
    "checkpoint_closing",
    "stats_with_empty",
    "stream_deduplicated",
    "handoff_resumed",
    "lag_gauge",
    "rebalance_plan",
    "shard_generations",
    "stream_leases",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["records_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        took[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
