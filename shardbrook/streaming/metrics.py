"""Live metrics: every interval's figures leave the stream when its time is over.

Each operator first reduces the stream to one row per key and interval, which Spark does
on the map side, so however hot a shard is, few rows of it reach Python.  Those rows go
to keyed state that survives the interval.  Timers run on event time: the watermark,
moved on by other shards, makes a silent shard speak.

State is a few numbers for each key.  It is kept by Spark's checkpoint; a restarted
query goes on where it was.  Needs the RocksDB state store, which ``runner`` starts queries with
where the session names no other.

Processors are local classes, so that they travel to the executors by value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shardbrook.functions.measures import payload_bytes, statistic_set
from shardbrook.operators.intervals import (
    DEFAULT_INTERVAL,
    lease_sums,
    metric_columns,
    record_columns,
    sample_columns,
)
from shardbrook.operators.publish import metrics_long
from shardbrook.schema import SHARD_KEYS

# Rows of zeros handed to Spark at once.
_ROWS = 10_000


def _closed(
    rows: DataFrame, time: str, interval: str, keys: Sequence[str], figures: Sequence[Column]
) -> DataFrame:
    """Figures per interval and key, given out once the watermark has passed the interval.

    ``_at`` carries the watermark on to the next operator.
    """
    grouped = rows.groupBy(F.window(time, interval).alias("_w"), *keys).agg(*figures)
    figured = [c for c in grouped.columns if c not in ("_w", *keys)]
    return grouped.select(
        F.window_time("_w").alias("_at"),
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *keys,
        *figured,
    )


def stream_leases(
    lease_events: DataFrame, interval: str = DEFAULT_INTERVAL, delay: str = "1 minute"
) -> DataFrame:
    """Renewals in each interval, and leases held at its end.

    Renewals begin anew with each interval; leases held are never reset.  A row for each
    worker and shard and interval with lease events, as in ``lease_metrics``.
    """
    keys = [*SHARD_KEYS, "worker"]

    class Held(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.held = handle.getValueState("held", "n bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            before = self.held.get()[0] if self.held.exists() else 0
            found = pd.concat(list(rows)).sort_values("window_start")
            held = before + found["net"].cumsum()
            self.held.update((int(held.iloc[-1]),))
            yield pd.DataFrame(
                {
                    "window_start": found["window_start"],
                    "window_end": found["window_end"],
                    "stream": key[0],
                    "shard_id": key[1],
                    "worker": key[2],
                    "n_renewals": found["n_renewals"],
                    "leases_held": held,
                }
            )

        def close(self) -> None:
            pass

    closed = _closed(
        lease_events.withWatermark("ts", delay), "ts", interval, keys, lease_sums("net")
    )
    return closed.groupBy(*keys).transformWithStateInPandas(
        Held(),
        "window_start timestamp, window_end timestamp, stream string, "
        "shard_id string, worker string, n_renewals bigint, leases_held bigint",
        "Append",
        "None",
    )


def stream_stats_dense(
    samples: DataFrame, interval_seconds: int, delay: str = "1 minute"
) -> DataFrame:
    """Count, sum, max, min per shard and interval, with zeros for silent intervals.

    ``samples`` has ``stream, shard_id, ts, value``.  A shard is known from its first row on,
    with a value or without; from then on it gives out a row for every interval, as
    soon as the watermark has passed it, whether or not anything came from it.
    """
    width = interval_seconds * 1000
    figures = ["sample_count", "sum", "maximum", "minimum"]
    rows_at_once = _ROWS

    class Dense(StatefulProcessor):
        """State is the end, in milliseconds, of the last interval given out."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.till = handle.getValueState("till", "at bigint")

        def silent(self, key, begin: int, end: int) -> Iterator[pd.DataFrame]:
            for first in range(begin, end, width * rows_at_once):
                starts = pd.Series(range(first, min(end, first + width * rows_at_once), width))
                yield self.rows(key, starts, [0, 0.0, 0.0, 0.0])

        def rows(self, key, starts: pd.Series, values: list) -> pd.DataFrame:
            named = dict(zip(figures, values))
            return pd.DataFrame(
                {
                    "window_start": pd.to_datetime(starts, unit="ms"),
                    "window_end": pd.to_datetime(starts + width, unit="ms"),
                    "stream": key[0],
                    "shard_id": key[1],
                    **named,
                }
            )

        def move_on(self, till: int) -> None:
            if self.till.exists():
                self.handle.deleteTimer(self.till.get()[0] + width)
            self.till.update((till,))
            self.handle.registerTimer(till + width)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            found = pd.concat(list(rows)).sort_values("window_start", ignore_index=True)
            starts = found["window_start"].astype("datetime64[ms]").astype("int64")
            till = self.till.get()[0] if self.till.exists() else int(starts.iloc[0])
            for start in starts:
                yield from self.silent(key, till, int(start))
                till = int(start) + width
            self.move_on(till)
            yield self.rows(key, starts, [found[f] for f in figures])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            till = self.till.get()[0]
            passed = till + (timerValues.getCurrentWatermarkInMs() - till) // width * width
            if passed > till:
                self.move_on(passed)
                yield from self.silent(key, till, passed)

        def close(self) -> None:
            pass

    closed = _closed(
        samples.withWatermark("ts", delay),
        "ts",
        f"{interval_seconds} seconds",
        SHARD_KEYS,
        statistic_set("value"),
    )
    return closed.groupBy(*SHARD_KEYS).transformWithStateInPandas(
        Dense(),
        "window_start timestamp, window_end timestamp, stream string, shard_id string, "
        "sample_count bigint, sum double, maximum double, minimum double",
        "Append",
        "EventTime",
    )


def stream_stalled(
    records: DataFrame, lease_seconds: int, bucket_seconds: int, delay: str = "1 minute"
) -> DataFrame:
    """Alerts: ``kind, stream, shard_id, last_arrival, at``.

    ``stalled`` leaves the stream when a shard has been silent for longer than the lease
    (``at`` is when the lease ran out), without any input from it.  ``back`` follows when
    records arrive again (``at`` is the first of them).

    Records are first reduced to buckets of ``bucket_seconds``; that is how late an alert can
    come after the watermark has passed its time, and no alert is given too early.
    """
    lease, bucket = lease_seconds * 1_000_000, bucket_seconds * 1_000_000

    class Stalled(StatefulProcessor):
        """State: the last arrival in microseconds, and whether its alert is out."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "at bigint, told boolean")

        def due(self, last: int) -> int:
            """When all records up to the end of the lease are known, in milliseconds."""
            return ((last + lease) // bucket + 1) * bucket // 1000

        def alerts(self, key, found: list) -> pd.DataFrame:
            kinds, lasts, times = zip(*found)
            return pd.DataFrame(
                {
                    "kind": kinds,
                    "stream": key[0],
                    "shard_id": key[1],
                    "last_arrival": pd.to_datetime(pd.Series(lasts), unit="us"),
                    "at": pd.to_datetime(pd.Series(times), unit="us"),
                }
            )

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            found = pd.concat(list(rows)).sort_values("window_start")
            firsts = found["first_ts"].astype("datetime64[us]").astype("int64")
            lasts = found["last_ts"].astype("datetime64[us]").astype("int64")
            last, told = self.last.get() if self.last.exists() else (None, False)
            if last is not None and not told:
                self.handle.deleteTimer(self.due(last))
            out = []
            for begin, end in zip(firsts.tolist(), lasts.tolist()):
                if last is not None and begin > last + lease:
                    if not told:
                        out.append(("stalled", last, last + lease))
                    out.append(("back", last, begin))
                last, told = end, False
            self.last.update((last, False))
            self.handle.registerTimer(self.due(last))
            if out:
                yield self.alerts(key, out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            last, told = self.last.get()
            if not told and expiredTimerInfo.getExpiryTimeInMs() == self.due(last):
                self.last.update((last, True))
                yield self.alerts(key, [("stalled", last, last + lease)])

        def close(self) -> None:
            pass

    closed = _closed(
        records.withWatermark("arrival_ts", delay),
        "arrival_ts",
        f"{bucket_seconds} seconds",
        SHARD_KEYS,
        [F.min("arrival_ts").alias("first_ts"), F.max("arrival_ts").alias("last_ts")],
    )
    return closed.groupBy(*SHARD_KEYS).transformWithStateInPandas(
        Stalled(),
        "kind string, stream string, shard_id string, last_arrival timestamp, at timestamp",
        "Append",
        "EventTime",
    )


def stream_shard_metrics(
    records: DataFrame,
    samples: DataFrame,
    interval: str = DEFAULT_INTERVAL,
    delay: str = "1 minute",
) -> DataFrame:
    """``shard_metrics`` as a stream: all metrics of a shard and interval in one row.

    Two stateful steps: records and samples are reduced to a row per shard, interval and
    metric; when the watermark has passed an interval those few rows are brought together.
    """
    counted = _closed(
        records.withWatermark("arrival_ts", delay),
        "arrival_ts",
        interval,
        SHARD_KEYS,
        [F.count("*").alias("n_records"), F.sum(payload_bytes()).alias("n_bytes")],
    )
    measured = _closed(
        samples.withWatermark("ts", delay),
        "ts",
        interval,
        [*SHARD_KEYS, "metric"],
        statistic_set("value"),
    )
    place = ["_at", *SHARD_KEYS]
    together = record_columns(counted, place).unionByName(sample_columns(measured, place))
    rows = together.groupBy(F.window("_at", interval).alias("_w"), *SHARD_KEYS).agg(
        *metric_columns()
    )
    return rows.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *[c for c in rows.columns if c != "_w"],
    )


def stream_metrics_long(
    records: DataFrame,
    samples: DataFrame,
    lease_events: DataFrame,
    interval: str = DEFAULT_INTERVAL,
    delay: str = "1 minute",
) -> DataFrame:
    """The long metric table as a stream, an interval's rows when its time is over."""
    return metrics_long(
        stream_shard_metrics(records, samples, interval, delay),
        stream_leases(lease_events, interval, delay),
        "window_end",
    )
