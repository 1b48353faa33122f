"""Metrics in published form: a long table, or text exposition lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_NAMESPACE = "shardbrook"

# Names, units, label and dimension names that dashboards rely on.
RECORDS = ("RecordsProcessed", "Count")
BYTES = ("DataBytesProcessed", "Byte")
LAG = ("MillisBehindLatest", "Milliseconds")
FETCH = ("KinesisDataFetcher.getRecords.Time", "Milliseconds")
PROCESS = ("RecordProcessor.processRecords.Time", "Milliseconds")
RENEWALS = ("RenewLease.Success", "Count")
LEASES = ("CurrentLeases", "Count")
SHARD_DIM, STREAM_DIM, WORKER_DIM = "shard", "KinesisStreamName", "WorkerID"
SHARD_LABEL, STREAM_LABEL, WORKER_LABEL = "shard", "kinesisStream", "workerID"

_STATS = "struct<sample_count:double,sum:double,maximum:double,minimum:double>"


def _datum(metric: tuple[str, str], value: Column | None = None, prefix: str = "") -> Column:
    name, unit = metric
    if value is None:
        stats = F.struct(
            *[
                F.col(f"{prefix}_{s}").cast("double").alias(s)
                for s in ("sample_count", "sum", "maximum", "minimum")
            ]
        )
        value = F.lit(None)
    else:
        stats = F.lit(None)
    return F.struct(
        F.lit(name).alias("metric"),
        F.lit(unit).alias("unit"),
        value.cast("double").alias("value"),
        stats.cast(_STATS).alias("stats"),
    )


def metrics_long(shard_metrics: DataFrame, lease_metrics: DataFrame, ts: str) -> DataFrame:
    """One row per metric: five per shard row, two per shard-and-worker row.

    Inputs are the interval tables; ``ts`` names their time column.  Each row
    has either ``value`` or ``stats``.
    """
    where = [F.lit(SHARD_DIM), F.col("shard_id"), F.lit(STREAM_DIM), F.col("stream")]
    per_shard = shard_metrics.select(
        F.create_map(*where).alias("dims"),
        F.col(ts).alias("ts"),
        F.inline(
            F.array(
                _datum(RECORDS, F.col("n_records")),
                _datum(BYTES, F.col("n_bytes")),
                _datum(LAG, prefix="lag"),
                _datum(FETCH, prefix="fetch"),
                _datum(PROCESS, prefix="process"),
            )
        ),
    )
    per_worker = lease_metrics.select(
        F.create_map(*where, F.lit(WORKER_DIM), F.col("worker")).alias("dims"),
        F.col(ts).alias("ts"),
        F.inline(
            F.array(
                _datum(RENEWALS, F.col("n_renewals")),
                _datum(LEASES, F.col("leases_held")),
            )
        ),
    )
    order = ["metric", "dims", "unit", "ts", "value", "stats"]
    return per_shard.select(*order).unionByName(per_worker.select(*order))


def flat_metrics(long: DataFrame) -> DataFrame:
    """``metrics_long`` without map and struct columns."""
    return long.select(
        "metric",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("dims")),
                lambda e: F.concat(e["key"], F.lit("="), e["value"]),
            ),
            ",",
        ).alias("dims"),
        "unit",
        "ts",
        "value",
        *[F.col(f"stats.{s}").alias(s) for s in ("sample_count", "sum", "maximum", "minimum")],
    )


# Metric name suffixes and kinds; the help texts are free.
FAMILIES = {
    "processed_bytes": ("counter", "Bytes of payload handed over"),
    "processed_records": ("counter", "Records handed over"),
    "behind_latest_millis": ("gauge", "Milliseconds behind the newest record"),
    "leases_held": ("gauge", "Leases a worker holds"),
    "lease_renewals": ("counter", "Leases renewed"),
    "get_records_duration_milliseconds": ("histogram", "Time to fetch and process a batch"),
    "process_records_duration_milliseconds": ("histogram", "Time to process a batch"),
}
_ORDER = {name: i for i, name in enumerate(FAMILIES)}


def _number(value: Column) -> Column:
    """Whole numbers without a fraction, infinity as +Inf; counters keep every digit.

    Doubles of 2^63 and more have no bigint and print in scientific notation.
    """
    text = value.cast("string")
    double = value.cast("double")
    whole = (double == F.floor(double)) & (F.abs(double) < 2.0**63)
    return (
        F.when(double == float("inf"), F.lit("+Inf"))
        .when(~text.rlike("[.E]"), text)
        .when(whole, value.cast("bigint").cast("string"))
        .otherwise(text)
    )


def _label(name: str, value: Column) -> Column:
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(escaped, F.lit('"'), F.lit('\\"'))
    escaped = F.replace(escaped, F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit(f'{name}="'), escaped, F.lit('"'))


def _line(
    namespace: str, family: str, labels: list[Column], value: Column, part: str = "", rank: int = 0
) -> Column:
    """A sample line with what is needed to put it in its place."""
    return F.struct(
        F.lit(_ORDER[family]).alias("family"),
        F.lit(rank).alias("part"),
        F.concat(
            F.lit(f"{namespace}_{family}{part}{{"),
            F.concat_ws(",", *labels),
            F.lit("} "),
            _number(value),
        ).alias("line"),
    )


def exposition(
    totals: DataFrame,
    lease_totals: DataFrame,
    histograms: DataFrame,
    namespace: str = DEFAULT_NAMESPACE,
) -> DataFrame:
    """Cumulative metrics as exposition text, one line per row.

    ``totals``: stream, shard_id, n_bytes, n_records, lag_ms.
    ``lease_totals``: stream, shard_id, worker, leases_held, n_renewals.
    ``histograms``: the output of ``sample_histogram`` for fetch and process.

    Sorting by every column but ``line`` gives the document; ``sinks`` does so.
    """
    base = [_label(STREAM_LABEL, F.col("stream")), _label(SHARD_LABEL, F.col("shard_id"))]
    place = ["stream", "shard_id"]
    none = F.lit("").alias("worker"), F.lit(float("-inf")).alias("le")

    shard_lines = totals.select(
        *place,
        *none,
        F.inline(
            F.array(
                _line(namespace, "processed_bytes", base, F.col("n_bytes")),
                _line(namespace, "processed_records", base, F.col("n_records")),
                _line(namespace, "behind_latest_millis", base, F.col("lag_ms")),
            )
        ),
    )
    by_worker = [*base, _label(WORKER_LABEL, F.col("worker"))]
    lease_lines = lease_totals.select(
        *place,
        "worker",
        none[1],
        F.inline(
            F.array(
                _line(namespace, "leases_held", by_worker, F.col("leases_held")),
                _line(namespace, "lease_renewals", by_worker, F.col("n_renewals")),
            )
        ),
    )
    bucket = [*base, F.concat(F.lit('le="'), _number(F.col("le")), F.lit('"'))]
    is_last = F.col("le") == float("inf")

    def histogram_lines(family: str) -> Column:
        """A bucket line per row; the +Inf row also stands for the whole group."""
        own = _line(namespace, family, bucket, F.col("cum_count"), "_bucket", 0)
        whole = [
            _line(namespace, family, base, F.col("sample_sum"), "_sum", 1),
            _line(namespace, family, base, F.col("sample_count"), "_count", 2),
        ]
        return F.when(is_last, F.array(own, *whole)).otherwise(F.array(own))

    timing_lines = histograms.filter(F.col("metric").isin("fetch", "process")).select(
        *place,
        none[0],
        "le",
        F.inline(
            F.when(
                F.col("metric") == "fetch", histogram_lines("get_records_duration_milliseconds")
            ).otherwise(histogram_lines("process_records_duration_milliseconds"))
        ),
    )
    lines = shard_lines.unionByName(lease_lines).unionByName(timing_lines)
    heads = [
        F.struct(F.lit(_ORDER[family]), F.lit(part), F.lit(f"# {text}"))
        for family, (kind, help_text) in FAMILIES.items()
        for part, text in (
            (-2, f"HELP {namespace}_{family} {help_text}"),
            (-1, f"TYPE {namespace}_{family} {kind}"),
        )
    ]
    head_lines = totals.sparkSession.range(1).select(
        F.lit("").alias("stream"),
        F.lit("").alias("shard_id"),
        *none,
        F.inline(F.array(*heads)).alias("family", "part", "line"),
    )
    return lines.unionByName(head_lines).select(
        "family", "stream", "shard_id", "worker", "part", "le", "line"
    )


def publish(
    service: str | None,
    *,
    long: DataFrame | None = None,
    text: DataFrame | None = None,
) -> DataFrame | None:
    """Pick the form a monitoring service takes; none means no metrics."""
    forms = {"": None, "cloudwatch": long, "prometheus": text}
    if (service or "") not in forms:
        raise ValueError(f"unknown monitoring service: {service}")
    return forms[service or ""]
