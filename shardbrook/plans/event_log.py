"""The ``events`` table seen as a record log, and tables derived from it.

events(event_id, ts, user_id, event_type, value, props) has one row per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardbrook.functions.measures import whole_millis
from shardbrook.operators.intervals import FETCH, LAG, PROCESS
from shardbrook.sources.log import append_records, as_records, read_log
from shardbrook.storage import shared_dir, store

STREAM = "events"

# Two ways to cut the log into shards: four busy ones, or one per user.
FOUR_SHARDS = "concat('shardId-', lpad(cast(user_id % 4 AS string), 3, '0'))"
USER_SHARDS = "cast(user_id AS string)"
WIDTH = 20
SEQUENCE = f"lpad(cast(event_id AS string), {WIDTH}, '0')"
WORKER = "concat('worker-', cast(user_id % 3 AS string))"

_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream; watermarks need a timestamp with zone.

    Files carry no order in time.  Without a limit all of them come in one
    micro-batch, so that no event is late; a limit suits stateless use.  A
    stream refuses the path of a single file, but takes a pattern for it.
    """
    reader = spark.readStream.schema(_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/events.parque[t]").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def records_of(
    events: DataFrame, shard_id: str = FOUR_SHARDS, key: str = "cast(user_id AS string)"
) -> DataFrame:
    return as_records(
        events,
        STREAM,
        shard_id=shard_id,
        sequence_number=SEQUENCE,
        partition_key=key,
        data="encode(props, 'UTF-8')",
        arrival_ts="ts",
    )


def records(spark: SparkSession, sf_dir: str, shard_id: str = FOUR_SHARDS) -> DataFrame:
    return records_of(events(spark, sf_dir), shard_id)


def halfway(events: DataFrame):
    """An id half-way through the log: a moment in the past."""
    return events.agg(F.max("event_id") / 2).scalar()


def progress_of(events: DataFrame) -> DataFrame:
    """A progress table with one row per user.

    Every third user is checkpointed at the end, the others half-way.  Users whose
    last event is an error have no owner; those whose last value is above 60 are
    closed; every tenth has a claim on it.
    """
    # Numbers only, so that the log is reduced by hash; then the last event's own row.
    ends = events.groupBy("user_id").agg(
        F.max(F.when(F.col("event_id") < halfway(events), F.col("event_id"))).alias("half"),
        F.max("event_id").alias("last"),
        F.max("ts").alias("last_ts"),
    )
    last = events.select(
        F.col("event_id").alias("last"), "event_type", F.col("value").alias("last_value")
    )
    return ends.join(last, "last").select(
        F.lit(STREAM).alias("stream"),
        F.when(F.col("user_id") % 3 == 0, F.col("last")).otherwise(F.col("half")).alias("at"),
        F.nullif("event_type", F.lit("error")).alias("owner"),
        "last_ts",
        "last_value",
        "user_id",
    ).select(
        "stream",
        F.expr(USER_SHARDS).alias("shard_id"),
        F.expr(f"lpad(cast(at AS string), {WIDTH}, '0')").alias("sequence_id"),
        "owner",
        F.expr("last_ts + INTERVAL 30 SECONDS").cast("timestamp").alias("lease_timeout"),
        F.lit(None).cast("string").alias("parent_shard_id"),
        (F.col("last_value") > 60).alias("closed"),
        F.when(F.col("user_id") % 10 == 0, F.lit("claimant")).alias("claim_request"),
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``progress_of`` as a stored table, which is what a progress table is."""
    return store(progress_of(events(spark, sf_dir)), "progress")


def lineage_of(events: DataFrame) -> DataFrame:
    """User shards and their parents: each follows from one with a smaller number.

    Every seventh is a merge of two; every eleventh has a parent that is gone.
    """
    user = F.col("user_id")
    half = F.expr("cast((user_id - 1) div 2 AS string)")
    third = F.expr("cast((user_id - 1) div 3 AS string)")
    gone = F.concat(F.lit("gone-"), user.cast("string"))
    parents = (
        F.when(user == 0, F.array(F.lit(None).cast("string")))
        .when(user % 11 == 0, F.array(gone))
        .when(user % 7 == 0, F.array(half, third))
        .otherwise(F.array(half))
    )
    return events.select("user_id").distinct().select(
        F.lit(STREAM).alias("stream"),
        F.expr(USER_SHARDS).alias("shard_id"),
        F.explode(parents).alias("parent_shard_id"),
    )


def stored_log(spark: SparkSession, sf_dir: str, shard_id: str = FOUR_SHARDS) -> DataFrame:
    """The records as a log in files: a folder for each shard, or for each sixteenth of many."""
    path = shared_dir(spark, "log")
    recs = records(spark, sf_dir, shard_id)
    if shard_id == FOUR_SHARDS:
        append_records(recs, path)
    else:
        part = F.pmod(F.xxhash64("shard_id"), F.lit(16))
        append_records(recs.withColumn("part", part), path, "part")
    return read_log(spark, path)


def samples_of(events: DataFrame) -> DataFrame:
    """Measured values: clicks as lag, purchases and views as durations.

    The value is taken as milliseconds with a fraction, turned into nanoseconds
    and cut to whole milliseconds, as durations are.
    """
    metric = F.expr(
        f"CASE event_type WHEN 'click' THEN '{LAG}' WHEN 'purchase' THEN '{FETCH}' "
        f"WHEN 'view' THEN '{PROCESS}' END"
    )
    nanos = F.expr("cast(round(value * 1000000) AS bigint)")
    return events.filter(F.col("event_type").isin("click", "purchase", "view")).select(
        F.lit(STREAM).alias("stream"),
        F.expr(FOUR_SHARDS).alias("shard_id"),
        "ts",
        metric.alias("metric"),
        whole_millis(nanos).alias("value"),
    )


def lease_events_of(events: DataFrame) -> DataFrame:
    """Signups gain a lease, errors lose one, views renew one."""
    kind = F.expr(
        "CASE event_type WHEN 'signup' THEN 'gained' WHEN 'error' THEN 'lost' "
        "WHEN 'view' THEN 'renewed' END"
    )
    return events.filter(F.col("event_type").isin("signup", "error", "view")).select(
        "event_id",
        F.lit(STREAM).alias("stream"),
        F.expr(FOUR_SHARDS).alias("shard_id"),
        F.expr(WORKER).alias("worker"),
        "ts",
        kind.alias("kind"),
    )
