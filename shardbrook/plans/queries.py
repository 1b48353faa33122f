"""The registered queries: every operator over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardbrook.functions.sequence import seq_key
from shardbrook.operators import (
    activity,
    catalog,
    counters,
    delivery,
    intervals,
    lineage,
    owners,
    positions,
    publish,
    running,
    samples,
)
from shardbrook.operators import progress as checkpoints
from shardbrook.plans import event_log as log
from shardbrook.sources import sinks
from shardbrook.sources.log import append_records, stream_log
from shardbrook.sources.progress_table import (
    add_owners,
    add_updates,
    empty_progress,
    read_progress,
    write_base,
)
from shardbrook.storage import shared_dir, store
from shardbrook.streaming import handoff, metrics, ordered, push, runner, windows
from shardbrook.streaming.timing import BatchTimes, batch_samples

Query = Callable[[SparkSession, str], DataFrame]

HOUR = "1 hour"
DAY_SECONDS = 86_400
GAP_SECONDS = 1800
BUCKET_SECONDS = 3600
FILES_PER_BATCH = 1000
MILLIS_EDGES = (5, 10, 25, 50, 100, 250, 500)


def _payload_as_text(records: DataFrame) -> DataFrame:
    return records.select(
        "stream",
        "shard_id",
        "sequence_number",
        "partition_key",
        F.decode("data", "UTF-8").alias("payload"),
    )


def _identity(records: DataFrame) -> DataFrame:
    return records.select("shard_id", "sequence_number")


# --- reading and starting -------------------------------------------------


def records_scan(spark, sf_dir):
    return _payload_as_text(log.records(spark, sf_dir))


def log_roundtrip(spark, sf_dir):
    """The records appended to a stored log, and read from it as a stream."""
    place = shared_dir(spark, "log")
    append_records(log.records(spark, sf_dir), f"{place}/log")
    rows, _ = _appended(spark, "roundtrip", stream_log(spark, f"{place}/log"))
    return _payload_as_text(rows)


def shard_catalog(spark, sf_dir):
    return catalog.shard_catalog(log.records(spark, sf_dir)).drop("parent_shard_id")


def new_shards(spark, sf_dir):
    """User shards that were not in the log on its first day."""
    ev = log.events(spark, sf_dir)
    first_day = ev.agg(F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 1 DAY")).scalar()
    then = log.records_of(ev.filter(F.col("ts") < first_day), log.USER_SHARDS)
    now = catalog.list_shards(log.records_of(ev, log.USER_SHARDS))
    return catalog.new_shards(now, catalog.list_shards(then)).select("shard_id")


def start_trim_horizon(spark, sf_dir):
    return _identity(
        positions.start_at(log.records(spark, sf_dir), positions.TRIM_HORIZON)
    )


def start_latest(spark, sf_dir):
    """A consumer that first started when half of the log was there."""
    ev = log.events(spark, sf_dir)
    then = log.records_of(ev.filter(F.col("event_id") < log.halfway(ev)))
    tips = positions.freeze_tips(then)
    return _identity(positions.start_at(log.records_of(ev), positions.LATEST, tips=tips))


def start_after_sequence(spark, sf_dir):
    return _identity(
        positions.start_at(
            log.records(spark, sf_dir),
            positions.AFTER_SEQUENCE_NUMBER,
            sequence_number="00000000000000000500",
        )
    )


def resume_after_checkpoint(spark, sf_dir):
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    return _identity(positions.resume(recs, log.progress(spark, sf_dir)))


def start_after_sequence_stored(spark, sf_dir):
    """The same start on a stored log, whose row groups it prunes."""
    return _identity(
        positions.start_at(
            log.stored_log(spark, sf_dir),
            positions.AFTER_SEQUENCE_NUMBER,
            sequence_number="00000000000000000500",
        )
    )


def resume_stored_log(spark, sf_dir):
    """Resume of a stored log, in groups of shards that stand about equally far."""
    stored = log.stored_log(spark, sf_dir, log.USER_SHARDS)
    return _identity(positions.resume_by_groups(stored, log.progress(spark, sf_dir)))


def shard_generations(spark, sf_dir):
    return lineage.shard_generations(log.lineage_of(log.events(spark, sf_dir))).drop("stream")


def readable_shards(spark, sf_dir):
    """Shards whose ancestors are all closed and read to the end."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    ended = log.progress(spark, sf_dir).filter("closed")
    drained = checkpoints.drained_shards(ended.select("stream", "shard_id", "sequence_id"), recs)
    shards = log.lineage_of(log.events(spark, sf_dir))
    return lineage.readable_shards(shards, drained).drop("stream")


# --- progress ---------------------------------------------------------------


def checkpoint_lookup(spark, sf_dir):
    """The checkpoint of every shard."""
    shards = catalog.list_shards(log.records(spark, sf_dir, log.USER_SHARDS))
    return checkpoints.lookup_checkpoints(shards, log.progress(spark, sf_dir)).select(
        "shard_id", "sequence_id", "owner"
    )


def checkpoint_latest(spark, sf_dir):
    return checkpoints.latest_checkpoints(log.records(spark, sf_dir)).drop("stream")


def checkpoint_manual(spark, sf_dir):
    """Checkpoint only at purchases."""
    # What marks the ends is taken along as the partition key.
    recs = log.records_of(log.events(spark, sf_dir), key="event_type")
    ends = F.col("partition_key") == "purchase"
    return checkpoints.manual_checkpoints(recs, ends).drop("stream")


def checkpoint_upsert(spark, sf_dir):
    """Every user's newest record, written by the owner named 'view'."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    return checkpoints.upsert_checkpoints(
        log.progress(spark, sf_dir), checkpoints.latest_checkpoints(recs), writer="view"
    ).select("shard_id", "sequence_id", "owner", "closed", "claim_request")


def shard_drained(spark, sf_dir):
    """Closed shards, and whether nothing is left after their checkpoint."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    ended = log.progress(spark, sf_dir).filter("closed").select(
        "stream", "shard_id", "sequence_id"
    )
    return checkpoints.drained_shards(ended, recs).select("shard_id", "sequence_id", "drained")


def checkpoint_closing(spark, sf_dir):
    """Stored checkpoints written again: closed where the shard has ended and is drained."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    stored = log.progress(spark, sf_dir)
    updates = stored.select("stream", "shard_id", "sequence_id")
    marked = checkpoints.closing_updates(updates, stored.filter("closed"), recs)
    return marked.drop("stream")


def _replayed(spark, sf_dir):
    """All records, and once more those after the stored checkpoints."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    return recs.unionByName(positions.resume(recs, log.progress(spark, sf_dir)))


def duplicate_deliveries(spark, sf_dir):
    return delivery.duplicate_deliveries(_replayed(spark, sf_dir)).select(
        "shard_id", "sequence_number", "n_delivered"
    )


def duplicate_runs(spark, sf_dir):
    """The same from runs: one reader had the whole log, another began at the checkpoints."""
    stored = log.stored_log(spark, sf_dir, log.USER_SHARDS)
    first = positions.shard_tips(stored).select(
        "stream", "shard_id", F.lit(None).cast("string").alias("low_key"), F.col("tip_key").alias("high_key")
    )
    first = store(first, "runs")
    low = seq_key(F.nullif("sequence_id", F.lit("")))
    second = first.drop("low_key").join(
        log.progress(spark, sf_dir).select("stream", "shard_id", low.alias("low_key")),
        ["stream", "shard_id"],
        "left",
    )
    return delivery.duplicate_runs(first.unionByName(second), stored).drop("stream")


def deduplicated_deliveries(spark, sf_dir):
    return _payload_as_text(delivery.drop_duplicate_deliveries(_replayed(spark, sf_dir)))


# --- metrics ----------------------------------------------------------------


def records_processed(spark, sf_dir):
    return counters.records_processed(log.records(spark, sf_dir))


def bytes_processed(spark, sf_dir):
    return counters.bytes_processed(log.records(spark, sf_dir))


def lag_latest(spark, sf_dir):
    return counters.lag_latest(log.records(spark, sf_dir)).select("shard_id", "lag_us")


def lag_gauge(spark, sf_dir):
    return counters.lag_gauge(log.samples_of(log.events(spark, sf_dir))).drop("stream")


def shard_summary(spark, sf_dir):
    """Records, bytes and lag per shard."""
    return counters.with_lag(counters.throughput(log.records(spark, sf_dir)))


def lag_stats(spark, sf_dir):
    found = log.samples_of(log.events(spark, sf_dir)).filter(F.col("metric") == intervals.LAG)
    return samples.sample_stats(found, HOUR).drop("metric", "stream", "window_end")


def duration_stats(spark, sf_dir):
    found = log.samples_of(log.events(spark, sf_dir)).filter(F.col("metric") != intervals.LAG)
    return samples.sample_stats(found, HOUR).drop("stream", "window_end")


def duration_histogram(spark, sf_dir):
    found = log.samples_of(log.events(spark, sf_dir)).filter(F.col("metric") != intervals.LAG)
    return samples.sample_histogram(found, MILLIS_EDGES).select(
        "shard_id",
        "metric",
        F.when(F.col("le") == float("inf"), "+Inf")
        .otherwise(F.col("le").cast("bigint").cast("string"))
        .alias("le"),
        "cum_count",
        "sample_count",
        "sample_sum",
    )


def running_gauge(spark, sf_dir):
    return running.leases_held(log.lease_events_of(log.events(spark, sf_dir))).select(
        "shard_id", "worker", "event_id", "leases_held"
    )


def event_counter(spark, sf_dir):
    return counters.event_counts(log.lease_events_of(log.events(spark, sf_dir))).drop("stream")


def metrics_windowed(spark, sf_dir):
    return intervals.throughput_by_interval(log.records(spark, sf_dir))


def untimed_records(spark, sf_dir):
    """A log in which every fiftieth user's records have lost their time."""
    recs = log.records(spark, sf_dir)
    lost = F.col("partition_key").cast("bigint") % 50 == 0
    timed = recs.withColumn("arrival_ts", F.when(~lost, F.col("arrival_ts")))
    return intervals.untimed_records(timed)


def metrics_hourly(spark, sf_dir):
    return intervals.throughput_by_interval(log.records(spark, sf_dir), HOUR)


def leases_windowed(spark, sf_dir):
    return intervals.lease_metrics(log.lease_events_of(log.events(spark, sf_dir)), HOUR)


def stats_with_empty(spark, sf_dir):
    """Purchase values per user and day; silent users show zeros, one row for each silence."""
    ev = log.events(spark, sf_dir)
    shards = catalog.list_shards(log.records_of(ev, log.USER_SHARDS))
    bought = ev.filter("event_type = 'purchase'").select(
        F.lit(log.STREAM).alias("stream"),
        F.expr(log.USER_SHARDS).alias("shard_id"),
        "ts",
        F.floor("value").cast("double").alias("value"),
    )
    return samples.sample_stats_dense(shards, bought, 86_400).drop("stream")


def metrics_long(spark, sf_dir):
    ev = log.events(spark, sf_dir)
    per_shard = intervals.shard_metrics(log.records_of(ev), log.samples_of(ev), HOUR)
    leases = intervals.lease_metrics(log.lease_events_of(ev), HOUR)
    return publish.flat_metrics(publish.metrics_long(per_shard, leases, "window_end"))


def metrics_text(spark, sf_dir):
    return _exposition(spark, sf_dir).select("line")


def _exposition(spark, sf_dir):
    ev = log.events(spark, sf_dir)
    totals = counters.with_lag(counters.throughput(log.records_of(ev))).withColumn(
        "lag_ms", F.floor(F.col("lag_us") / 1000)
    )
    leases = intervals.lease_metrics(log.lease_events_of(ev), None)
    timings = log.samples_of(ev).filter(F.col("metric") != intervals.LAG)
    histograms = samples.sample_histogram(timings, MILLIS_EDGES)
    return publish.exposition(totals, leases, histograms)


def metrics_stored(spark, sf_dir):
    """The long table as the metric sink stores it."""
    path = f"{shared_dir(spark, 'metrics')}/long"
    sinks.write_metrics(metrics_long(spark, sf_dir), path)
    return spark.read.parquet(path)


def metrics_text_stored(spark, sf_dir):
    """Exposition lines as the text sink stores them."""
    path = f"{shared_dir(spark, 'metrics')}/text"
    sinks.write_exposition(_exposition(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# --- reports ------------------------------------------------------------------


def active_owners(spark, sf_dir):
    return owners.active_owners(log.progress(spark, sf_dir)).drop("stream")


def owner_shard_lists(spark, sf_dir):
    lists = owners.owner_shard_lists(log.progress(spark, sf_dir), page_size=5)
    return lists.withColumn("shards", F.array_join("shards", ","))


def invalid_progress(spark, sf_dir):
    return owners.invalid_progress(log.progress(spark, sf_dir))


def owner_skew(spark, sf_dir):
    return owners.owner_skew(log.progress(spark, sf_dir)).drop("load")


def owner_skew_by_bytes(spark, sf_dir):
    weights = counters.bytes_processed(log.records(spark, sf_dir, log.USER_SHARDS))
    return owners.owner_skew(
        log.progress(spark, sf_dir), weights.withColumnRenamed("n_bytes", "weight")
    )


def heaviest_owner(spark, sf_dir):
    return owners.heaviest_owner(log.progress(spark, sf_dir)).drop("load")


def rebalance_plan(spark, sf_dir):
    """Moves to an even load, with one owner who holds nothing yet."""
    idle = spark.createDataFrame([("idle",)], "owner string")
    return owners.rebalance_plan(log.progress(spark, sf_dir), idle).drop("stream")


def stalled_shards(spark, sf_dir):
    """Users silent for a day when the log ends."""
    recs = log.records(spark, sf_dir, log.USER_SHARDS)
    return activity.stalled_shards(recs, lease_seconds=86_400).drop("stream")


def silence_gaps(spark, sf_dir):
    return activity.silence_gaps(log.records(spark, sf_dir), GAP_SECONDS).drop("stream")


def activity_sessions(spark, sf_dir):
    return activity.activity_sessions(log.records(spark, sf_dir), GAP_SECONDS).drop("stream")


def shard_positions(spark, sf_dir):
    return running.shard_positions(log.records(spark, sf_dir)).select(
        "shard_id", "sequence_number", "position"
    )


# --- hand-off and streams -------------------------------------------------------


def handoff_ordered(spark, sf_dir):
    """The payload size of each record, with its place in the shard."""

    # Local and without a base class, so that it travels to executors by value.
    class SizeOf:
        def init(self, shard_id: str) -> None:
            self.shard_id = shard_id
            self.last = None

        def process(self, batch: pd.DataFrame) -> pd.DataFrame:
            place = batch["position"]
            first = place.iloc[0] if self.last is None else self.last + 1
            if place.iloc[0] != first or not (place.diff().iloc[1:] == 1).all():
                raise ValueError(f"records of {self.shard_id} out of order")
            self.last = place.iloc[-1]
            return pd.DataFrame(
                {
                    "shard_id": self.shard_id,
                    "sequence_number": batch["sequence_number"],
                    "position": place,
                    "n_bytes": batch["data"].str.len(),
                }
            )

        def shutdown(self) -> None:
            pass

    return handoff.handoff_ordered(
        log.records(spark, sf_dir),
        SizeOf,
        "shard_id string, sequence_number string, position bigint, n_bytes bigint",
        columns=["sequence_number", "position", "data"],
    )


def handoff_live_ordered(spark, sf_dir):
    """A live log whose records arrive up to an hour late, handed over in order.

    It grows in three parts, and the stream is started anew for each.
    """

    class SizeOf:
        def init(self, shard_id: str) -> None:
            self.shard_id, self.last, self.inits = shard_id, 0, getattr(self, "inits", 0) + 1

        def process(self, batch: pd.DataFrame) -> pd.DataFrame:
            places = batch["position"]
            if places.iloc[0] != self.last + 1 or not (places.diff().iloc[1:] == 1).all():
                raise ValueError(f"records of {self.shard_id} out of order")
            self.last = int(places.iloc[-1])
            return pd.DataFrame(
                {
                    "shard_id": self.shard_id,
                    "sequence_number": batch["sequence_number"],
                    "position": places,
                    "n_bytes": batch["data"].str.len(),
                    "n_inits": self.inits,
                }
            )

        def shutdown(self) -> None:
            pass

    place = shared_dir(spark, "live")
    recs = log.records(spark, sf_dir).withColumn("arrival_ts", F.col("arrival_ts").cast("timestamp"))
    late = F.unix_micros("arrival_ts") + F.pmod(F.xxhash64("seq_key"), F.lit(3_600_000_000))
    first, last = recs.agg(F.min(F.unix_micros("arrival_ts")), F.max(F.unix_micros("arrival_ts"))).first()
    part = F.floor((late - first) * 3 / (last - first + 3_600_000_001))
    # A record of no shard, long after the others, lets them all go.
    beat = recs.limit(1).withColumn("shard_id", F.lit("beat")).withColumn(
        "arrival_ts", F.timestamp_micros(F.lit(last + 10 * 3_600_000_000))
    )
    schema = "shard_id string, sequence_number string, position bigint, n_bytes bigint, n_inits bigint"
    for number in range(3):
        here = recs.filter(part == number)
        (here if number < 2 else here.unionByName(beat)).write.mode("append").parquet(f"{place}/log")
        live = ordered.handoff_live(stream_log(spark, f"{place}/log"), SizeOf, schema, "2 hours")
        runner.run_to_end(runner.append_to_table(live, f"{place}/out", f"{place}/checkpoint"))
    return spark.read.schema(schema).parquet(f"{place}/out")


def handoff_batch(spark, sf_dir):
    """Stream the log through user code; what it wrote, read back."""
    place = shared_dir(spark, "handoff")

    def write(batch: DataFrame, batch_id: int) -> None:
        _payload_as_text(batch).write.mode("overwrite").parquet(f"{place}/out/batch={batch_id}")

    stream = log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH))
    runner.run_to_end(
        handoff.start_handoff(
            stream, write, checkpoint=f"{place}/checkpoint", progress_path=f"{place}/progress"
        )
    )
    return spark.read.parquet(f"{place}/out").drop("batch")


def handoff_stopped(spark, sf_dir):
    """What a hand-off without an end has delivered when it is stopped after a batch."""
    place = shared_dir(spark, "handoff")

    def write(batch: DataFrame, batch_id: int) -> None:
        _payload_as_text(batch).write.mode("overwrite").parquet(f"{place}/out/batch={batch_id}")

    query = handoff.start_handoff(
        log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH)),
        write,
        checkpoint=f"{place}/checkpoint",
        progress_path=f"{place}/progress",
        processingTime="0 seconds",
    )
    runner.after_batch(query)
    runner.stop(query)
    return spark.read.parquet(f"{place}/out").drop("batch")


def handoff_resumed(spark, sf_dir):
    """A new stream over a stored progress table: only what comes after it."""
    place = shared_dir(spark, "handoff")
    write_base(log.progress(spark, sf_dir), f"{place}/progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        _identity(batch).write.mode("overwrite").parquet(f"{place}/out/batch={batch_id}")

    stream = log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH), log.USER_SHARDS)
    runner.run_to_end(
        handoff.start_handoff(
            stream,
            write,
            checkpoint=f"{place}/checkpoint",
            progress_path=f"{place}/progress",
            resume=True,
        )
    )
    return spark.read.parquet(f"{place}/out").drop("batch")


def resume_two_streams(spark, sf_dir):
    """Two streams with the same shard ids; only one of them has progress."""
    ev = log.events(spark, sf_dir)
    name = F.when(F.col("sequence_number").cast("bigint") % 2 == 0, "east").otherwise("west")
    recs = log.records_of(ev, log.USER_SHARDS).withColumn("stream", name)
    east = checkpoints.latest_checkpoints(recs.filter("stream = 'east'"))
    stored = checkpoints.upsert_checkpoints(empty_progress(spark), east, "reader")
    return positions.resume(recs, stored).select("stream", "shard_id", "sequence_number")


def progress_two_writers(spark, sf_dir):
    """Two hand-offs that share one progress table, each with half of the shards."""
    place = shared_dir(spark, "handoff")
    for part, writer in enumerate(("even", "odd")):
        events = log.events_stream(spark, sf_dir, FILES_PER_BATCH).filter(f"user_id % 2 = {part}")
        runner.run_to_end(
            handoff.start_handoff(
                log.records_of(events, log.USER_SHARDS),
                lambda batch, batch_id: None,
                checkpoint=f"{place}/checkpoint-{writer}",
                progress_path=f"{place}/progress",
                writer=writer,
            )
        )
    return read_progress(spark, f"{place}/progress").select(
        "stream", "shard_id", "sequence_id", "owner", "closed"
    )


def handoff_progress(spark, sf_dir):
    """The progress table a streamed hand-off leaves behind."""
    place = shared_dir(spark, "handoff")
    stream = log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH))
    runner.run_to_end(
        handoff.start_handoff(
            stream,
            lambda batch, batch_id: None,
            checkpoint=f"{place}/checkpoint",
            progress_path=f"{place}/progress",
            writer="reader",
        )
    )
    return read_progress(spark, f"{place}/progress").select(
        "shard_id", "sequence_id", "owner", "closed"
    )


def handoff_from_latest(spark, sf_dir):
    """A hand-off that first started when half of the log was there."""
    place = shared_dir(spark, "handoff")
    ev = log.events(spark, sf_dir)
    then = log.records_of(ev.filter(F.col("event_id") < log.halfway(ev)))

    def write(batch: DataFrame, batch_id: int) -> None:
        _identity(batch).write.mode("overwrite").parquet(f"{place}/out/batch={batch_id}")

    stream = log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH))
    runner.run_to_end(
        handoff.start_handoff(
            stream, write, checkpoint=f"{place}/checkpoint", position=positions.LATEST, log=then
        )
    )
    return spark.read.parquet(f"{place}/out").drop("batch")


def progress_handed_over(spark, sf_dir):
    """One writer's shards, half of them taken over by another; the first one's late write."""
    place = f"{shared_dir(spark, 'progress')}/progress"
    ev = log.events(spark, sf_dir)
    half = log.halfway(ev)
    first = checkpoints.latest_checkpoints(
        log.records_of(ev.filter(F.col("event_id") < half), log.USER_SHARDS)
    )
    whole = checkpoints.latest_checkpoints(log.records_of(ev, log.USER_SHARDS))
    even = F.col("shard_id").cast("bigint") % 2 == 0
    sixth = F.col("shard_id").cast("bigint") % 6 == 0
    add_updates(first, place, 0, "before")
    add_owners(first.filter(even).withColumn("owner", F.lit("after")), place)
    add_updates(whole.filter(sixth), place, 0, "after")
    add_updates(whole, place, 1, "before")
    return read_progress(spark, place).select("shard_id", "sequence_id", "owner")


def handoff_times(spark, sf_dir):
    """Samples that the batches of a hand-off leave; the lag in milliseconds."""
    place = shared_dir(spark, "handoff")
    times = BatchTimes(spark, f"{place}/times")
    stream = log.records_of(log.events_stream(spark, sf_dir, FILES_PER_BATCH))
    runner.run_to_end(
        handoff.start_handoff(
            stream, lambda batch, batch_id: None, checkpoint=f"{place}/checkpoint", times=times
        )
    )
    times.close()
    lag = F.when(F.col("metric") == intervals.LAG, F.col("value"))
    return batch_samples(spark, f"{place}/times").select(
        "stream", "shard_id", "metric", (F.col("value") >= 0).alias("timed"), lag.alias("lag_ms")
    )


def _appended(spark, name: str, result: DataFrame):
    """What a stream appended, and the query that did."""
    place = shared_dir(spark, name)
    query = runner.run_to_end(
        runner.append_to_table(result, f"{place}/out", f"{place}/checkpoint")
    )
    return spark.read.schema(result.schema).parquet(f"{place}/out"), query


def stream_totals(spark, sf_dir):
    stream = log.records_of(log.events_stream(spark, sf_dir))
    totals = windows.stream_totals(stream)
    place = shared_dir(spark, "totals")
    runner.run_to_end(runner.keep_newest(totals, f"{place}/out", f"{place}/checkpoint"))
    return runner.read_newest(spark, f"{place}/out", totals.schema).select(
        "shard_id", "n_records", "n_bytes"
    )


def stream_windows(spark, sf_dir):
    """Hourly windows: those the watermark has closed, then the rest of the log's end."""
    stream = log.records_of(log.events_stream(spark, sf_dir))
    closed, query = _appended(
        spark, "windows", windows.stream_throughput_by_interval(stream, HOUR, HOUR)
    )
    tail = windows.open_windows(log.records(spark, sf_dir), HOUR, windows.final_watermark(query))
    columns = ["window_start", "shard_id", "n_records", "n_bytes"]
    return _with_tail(closed, tail, columns, ["window_start"])


def stream_sessions(spark, sf_dir):
    """Sessions: those the watermark has closed, then the rest of the log's end."""
    stream = log.records_of(log.events_stream(spark, sf_dir))
    closed, query = _appended(
        spark, "sessions", windows.stream_sessions(stream, GAP_SECONDS, HOUR)
    )
    tail = windows.open_sessions(
        log.records(spark, sf_dir), GAP_SECONDS, windows.final_watermark(query)
    )
    columns = ["shard_id", "session_start", "session_end", "n_records"]
    return _with_tail(closed, tail, columns, ["session_start", "session_end"])


def _with_tail(closed: DataFrame, tail: DataFrame, columns: list, times: list) -> DataFrame:
    """Both parts, with times as the events table has them."""
    return closed.select(columns).union(tail.select(columns)).select(
        *(F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in columns)
    )


def stream_deduplicated(spark, sf_dir):
    """Every record delivered twice, and kept once."""
    stream = log.records_of(log.events_stream(spark, sf_dir))
    twice = stream.unionByName(log.records_of(log.events_stream(spark, sf_dir)))
    kept, _ = _appended(spark, "dedup", windows.stream_drop_duplicates(twice, HOUR))
    return _payload_as_text(kept)


def metrics_pushed(spark, sf_dir):
    """What a service has after three pushes, of which it refused a shard's part twice."""
    place = f"{shared_dir(spark, 'push')}/outcomes"
    ev = log.events(spark, sf_dir)
    per_shard = intervals.shard_metrics(log.records_of(ev), log.samples_of(ev), HOUR)
    leases = intervals.lease_metrics(log.lease_events_of(ev), HOUR)
    long = store(publish.metrics_long(per_shard, leases, "window_end"), "long")

    def refusing(number: int):
        def take(rows: pd.DataFrame) -> None:
            if number < 2 and any(r["value"] == "shardId-001" for r in rows["labels"].iloc[0]):
                raise ConnectionError("refused")

        return take

    for number in range(3):
        third = long.filter(F.pmod(F.dayofmonth("ts"), F.lit(3)) == number)
        push.push_interval(third, refusing(number), place, number, rows_per_push=1)
    whole = push.carried_over(push.pushed_rows(spark, place))
    labels = F.array_join(F.transform("labels", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return whole.select(
        "metric", labels.alias("dims"), "unit", "value", "sample_count", "sum", "maximum", "minimum"
    )


def _rest(found: DataFrame, time: str, query) -> DataFrame:
    """Rows of a batch read whose time the watermark of an ended stream has not passed."""
    watermark = windows.final_watermark(query)
    return found if watermark is None else found.filter(F.col(time) > watermark)


def stream_leases(spark, sf_dir):
    """Hourly renewals and leases held: what the stream gave out, then the log's end."""
    stream = log.lease_events_of(log.events_stream(spark, sf_dir))
    closed, query = _appended(spark, "leases", metrics.stream_leases(stream, HOUR, HOUR))
    whole = intervals.lease_metrics(log.lease_events_of(log.events(spark, sf_dir)), HOUR)
    times = ["window_start", "window_end"]
    return _with_tail(closed, _rest(whole, "window_end", query), whole.columns, times)


def _bought(events: DataFrame) -> DataFrame:
    """Purchase values of each user; other events make the user known."""
    bought = F.when(F.col("event_type") == "purchase", F.floor("value").cast("double"))
    return events.select(
        F.lit(log.STREAM).alias("stream"),
        F.expr(log.USER_SHARDS).alias("shard_id"),
        "ts",
        bought.alias("value"),
    )


def stream_stats_with_empty(spark, sf_dir):
    """Purchase values per user and day since the user's first event, silent days as zeros."""
    stream = _bought(log.events_stream(spark, sf_dir))
    closed, query = _appended(spark, "dense", metrics.stream_stats_dense(stream, DAY_SECONDS, HOUR))
    whole = samples.sample_stats_every(_bought(log.events(spark, sf_dir)), DAY_SECONDS)
    times = ["window_start", "window_end"]
    found = _with_tail(closed, _rest(whole, "window_end", query), whole.columns, times)
    return found.drop("stream")


def stream_stalled(spark, sf_dir):
    """When users fell silent for a day, and when they were back."""
    stream = log.records_of(log.events_stream(spark, sf_dir), log.USER_SHARDS)
    told, query = _appended(
        spark, "stalled", metrics.stream_stalled(stream, DAY_SECONDS, BUCKET_SECONDS, HOUR)
    )
    whole = activity.stalls(log.records(spark, sf_dir, log.USER_SHARDS), DAY_SECONDS)
    known = F.window("at", f"{BUCKET_SECONDS} seconds").end
    tail = _rest(whole.withColumn("_known", known), "_known", query)
    columns = ["kind", "shard_id", "last_arrival", "at"]
    return _with_tail(told, tail, columns, ["last_arrival", "at"])


def stream_metrics_long(spark, sf_dir):
    """The hourly long table: what the stream gave out, then the log's end."""
    ev = log.events_stream(spark, sf_dir)
    long = metrics.stream_metrics_long(
        log.records_of(ev), log.samples_of(ev), log.lease_events_of(ev), HOUR, HOUR
    )
    closed, query = _appended(spark, "long", publish.flat_metrics(long))
    whole = metrics_long(spark, sf_dir)
    return _with_tail(closed, _rest(whole, "ts", query), whole.columns, ["ts"])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        records_scan,
        log_roundtrip,
        shard_catalog,
        new_shards,
        start_trim_horizon,
        start_latest,
        start_after_sequence,
        start_after_sequence_stored,
        resume_stored_log,
        shard_generations,
        readable_shards,
        resume_after_checkpoint,
        checkpoint_lookup,
        checkpoint_latest,
        checkpoint_manual,
        checkpoint_upsert,
        checkpoint_closing,
        shard_drained,
        duplicate_deliveries,
        duplicate_runs,
        deduplicated_deliveries,
        records_processed,
        bytes_processed,
        lag_latest,
        lag_gauge,
        shard_summary,
        lag_stats,
        duration_stats,
        duration_histogram,
        running_gauge,
        shard_positions,
        event_counter,
        untimed_records,
        metrics_windowed,
        metrics_hourly,
        leases_windowed,
        stats_with_empty,
        metrics_long,
        metrics_text,
        metrics_stored,
        metrics_text_stored,
        metrics_pushed,
        active_owners,
        owner_shard_lists,
        invalid_progress,
        owner_skew,
        owner_skew_by_bytes,
        heaviest_owner,
        rebalance_plan,
        stalled_shards,
        silence_gaps,
        activity_sessions,
        handoff_batch,
        handoff_progress,
        handoff_stopped,
        handoff_resumed,
        handoff_from_latest,
        progress_handed_over,
        handoff_times,
        resume_two_streams,
        progress_two_writers,
        handoff_ordered,
        handoff_live_ordered,
        stream_totals,
        stream_windows,
        stream_sessions,
        stream_deduplicated,
        stream_leases,
        stream_stats_with_empty,
        stream_stalled,
        stream_metrics_long,
    )
}
