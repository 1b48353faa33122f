"""Push metrics to a service, and carry over what it did not take.

A counter is reset only when its push has succeeded: what failed is added to the next
interval's figures and pushed with them.  Every push leaves an outcome table of its rows,
written once; the next one begins with the rows of it that were not taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardbrook.operators.publish import LEASES
from shardbrook.storage import folders, write_once
from shardbrook.streaming.runner import start

PushFunction = Callable[[pd.DataFrame], None]

_STATS = ["sample_count", "sum", "maximum", "minimum"]
_LABELS = "array<struct<key:string,value:string>>"
_OUTCOME = (
    f"metric string, labels {_LABELS}, unit string, ts timestamp, value double, "
    "sample_count double, sum double, maximum double, minimum double, pushed boolean"
)

# Metrics that show a state; of several values the newest is right, not their sum.
GAUGES = (LEASES[0],)

# Rows in one call of the push function.
ROWS = 1000


def flat_rows(long: DataFrame) -> DataFrame:
    """The long metric table with its labels as a sorted list and its statistics as columns."""
    return long.select(
        "metric",
        F.array_sort(F.map_entries("dims")).cast(_LABELS).alias("labels"),
        "unit",
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        *[F.col(f"stats.{s}").alias(s) for s in _STATS],
    )


def carried_over(rows: DataFrame) -> DataFrame:
    """One row per metric and labels of several intervals: what one longer interval would give.

    Counts and sums add up, maxima and minima are those of all samples, gauges keep the
    newest value.  The time is the newest.  A set without samples changes nothing.
    """
    some = F.col("sample_count") > 0
    newest = F.max_by("value", "ts")
    return rows.groupBy("metric", "labels", "unit").agg(
        F.max("ts").alias("ts"),
        F.when(F.col("metric").isin(*GAUGES), newest).otherwise(F.sum("value")).alias("value"),
        F.sum("sample_count").alias("sample_count"),
        F.sum("sum").alias("sum"),
        F.coalesce(F.max(F.when(some, F.col("maximum"))), F.max("maximum")).alias("maximum"),
        F.coalesce(F.min(F.when(some, F.col("minimum"))), F.min("minimum")).alias("minimum"),
    )


def push_interval(
    long: DataFrame, push: PushFunction, path: str, number: int, rows_per_push: int = ROWS
) -> DataFrame:
    """Push an interval's rows and what was carried over; the outcome, with ``pushed``.

    ``push`` gets rows as a pandas frame (``flat_rows``), on the executors, and raises if the
    service did not take them; then those rows are carried over.  ``number`` counts the
    intervals from 0.  A number whose outcome is stored is not pushed again.  A task that is
    lost after its push and before the outcome was stored pushes its rows once more.
    """
    spark, place = long.sparkSession, path.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            taken = []
            for first in range(0, len(batch), rows_per_push):
                part = batch.iloc[first : first + rows_per_push]
                try:
                    push(part)
                    taken += [True] * len(part)
                except Exception:
                    taken += [False] * len(part)
            yield batch.assign(pushed=taken)

    def build() -> DataFrame:
        due = flat_rows(long)
        before = spark.read.schema(_OUTCOME).parquet(f"{place}/{number - 1}/rows") if number else None
        if before is not None:
            due = carried_over(due.unionByName(before.filter("NOT pushed").drop("pushed")))
        return due.mapInPandas(run, _OUTCOME)

    return write_once(spark, f"{place}/{number}", _OUTCOME, build)


def start_push(
    long: DataFrame, push: PushFunction, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Push every micro-batch of a stream of metrics (``stream_metrics_long``) as an interval.

    Outcomes lie in ``path``, one folder for each batch; ``pushed_rows`` reads them.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        push_interval(batch, push, path, batch_id)

    return start(long.writeStream.foreachBatch(run), checkpoint, long.sparkSession, **trigger)


def pushed_rows(spark, path: str) -> DataFrame:
    """All rows that the service took."""
    numbers = sorted(folders(spark, path.rstrip("/")), key=int)
    places = [f"{path.rstrip('/')}/{n}/rows" for n in numbers]
    return spark.read.schema(_OUTCOME).parquet(*places).filter("pushed").drop("pushed")


def waiting_rows(spark, path: str) -> DataFrame:
    """The rows that the next push begins with."""
    last = max(map(int, folders(spark, path.rstrip("/"))))
    found = spark.read.schema(_OUTCOME).parquet(f"{path.rstrip('/')}/{last}/rows")
    return found.filter("NOT pushed").drop("pushed")
