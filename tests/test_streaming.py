"""Hand-off, restart and stream reports."""

import time

import pandas as pd
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shardbrook.operators import counters, intervals, positions
from shardbrook.operators.activity import activity_sessions
from shardbrook.operators.delivery import duplicate_deliveries
from shardbrook.operators.progress import closing_updates, latest_checkpoints, manual_checkpoints
from shardbrook.sources import progress_table as table
from shardbrook.sources.log import append_records, read_log, stream_log
from shardbrook.streaming import handoff, runner, windows
from shardbrook.streaming.timing import BatchTimes, batch_samples


class Consumer:
    """Streams a log through user code that stores what it is given."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.log, self.out = f"{root}/log", f"{root}/out"
        self.progress = f"{root}/progress"

    def push(self, records):
        append_records(records, self.log)

    def run(self, process=None, **options):
        def keep(batch, batch_id):
            batch.write.mode("append").parquet(self.out)

        options = {"writer": "w", "progress_path": self.progress, **options}
        query = handoff.start_handoff(
            stream_log(self.spark, self.log, options.pop("files", None)),
            process or keep,
            checkpoint=f"{self.root}/checkpoint",
            **options,
        )
        return runner.run_to_end(query)

    def stored(self):
        return rows(table.read_progress(self.spark, self.progress), "shard_id", "sequence_id")


@pytest.fixture
def consumer(spark, tmp_path):
    return Consumer(spark, str(tmp_path))


def test_restart_delivers_nothing_twice(spark, make, consumer):
    consumer.push(make.records([("a", "9", 1, b"abcd")]))
    consumer.run()
    assert consumer.stored() == [("a", "9")]
    consumer.run()
    consumer.push(make.records([("a", "10", 2, b"abcd"), ("b", "1", 2, b"")]))
    consumer.run()
    assert consumer.stored() == [("a", "10"), ("b", "1")]
    out = spark.read.parquet(consumer.out)
    assert out.count() == 3
    assert rows(duplicate_deliveries(out)) == []


def test_several_batches(make, consumer):
    for n in range(1, 12):
        consumer.push(make.records([("a", str(n), n, b"")]))
    query = consumer.run(files=1)
    assert len(query.recentProgress) >= 11
    assert consumer.stored() == [("a", "11")]


def test_a_failed_batch_is_handed_over_again(spark, make, consumer):
    consumer.push(make.records([("a", "1", 1, b"")]))

    def fail(batch, batch_id):
        raise RuntimeError("user code failed")

    with pytest.raises(Exception, match="user code failed"):
        consumer.run(fail)
    assert consumer.stored() == []
    consumer.run()
    assert spark.read.parquet(consumer.out).count() == 1
    assert consumer.stored() == [("a", "1")]


def test_replaying_a_batch_keeps_the_progress(spark, make, tmp_path):
    path = str(tmp_path / "progress")
    first = latest_checkpoints(make.records([("a", "1", 1, b"")]))
    second = latest_checkpoints(make.records([("a", "2", 1, b"")]))
    for version, update in [(0, first), (1, second), (1, second)]:
        handoff.commit_progress(update, path, version, "w")
    assert rows(table.read_progress(spark, path), "sequence_id") == [("2",)]


def test_a_new_stream_goes_on_with_the_table(spark, make, consumer, tmp_path):
    consumer.push(make.records([("a", "1", 1, b"")]))
    consumer.run()
    other = Consumer(spark, str(tmp_path / "other"))
    other.progress = consumer.progress
    other.push(make.records([("b", "5", 1, b"")]))
    other.run()
    other.push(make.records([("b", "6", 1, b"")]))
    other.run()
    assert other.stored() == [("a", "1"), ("b", "6")]


def test_manual_and_disabled_checkpoints(make, consumer):
    consumer.push(make.records([("a", "1", 1, b"end"), ("a", "2", 2, b"more")]))
    consumer.run(checkpoints_of=lambda batch: manual_checkpoints(batch, batch.data == b"end"))
    assert consumer.stored() == [("a", "1")]
    consumer.push(make.records([("a", "3", 3, b"end")]))
    consumer.run(checkpoints_of=None)
    assert consumer.stored() == [("a", "1")]
    consumer.push(make.records([("b", "4", 4, b"")]))
    consumer.run()
    assert consumer.stored() == [("a", "1"), ("b", "4")]


def test_ended_shards_are_closed(spark, make, consumer):
    consumer.push(make.records([("a", "1", 1, b""), ("b", "1", 1, b"")]))
    ended = spark.createDataFrame([("s", "a")], "stream string, shard_id string")
    consumer.run(
        checkpoints_of=lambda batch: closing_updates(
            latest_checkpoints(batch), ended, read_log(spark, consumer.log)
        )
    )
    stored = table.read_progress(spark, consumer.progress)
    assert rows(stored, "shard_id", "closed") == [("a", True), ("b", False)]


def test_resume_begins_after_the_stored_progress(spark, make, consumer, tmp_path):
    consumer.push(make.records([("a", "1", 1, b""), ("b", "1", 1, b"")]))
    consumer.run()
    consumer.push(make.records([("a", "2", 2, b""), ("c", "1", 2, b"")]))
    other = Consumer(spark, str(tmp_path / "other"))
    other.progress, other.log = consumer.progress, consumer.log
    other.run(resume=True)
    fresh = rows(spark.read.parquet(other.out), "shard_id", "sequence_number")
    assert fresh == [("a", "2"), ("c", "1")]
    consumer.push(make.records([("b", "2", 3, b"")]))
    other.run(resume=True)  # a restart skips the same ones
    again = rows(spark.read.parquet(other.out), "shard_id", "sequence_number")
    assert again == [("a", "2"), ("b", "2"), ("c", "1")]


def test_progress_respects_the_guard(spark, make, consumer):
    table.write_base(
        make.progress([("a", "1", "w", False, "claim"), ("b", "1", "x", False, None)]),
        consumer.progress,
    )
    consumer.push(make.records([("a", "9", 1, b""), ("b", "9", 1, b""), ("c", "9", 1, b"")]))
    consumer.run()
    assert consumer.stored() == [("a", "1"), ("b", "1"), ("c", "9")]


def test_every_batch_is_timed(spark, make, tmp_path):
    """More batches than Spark remembers; a batch of two shards, and a restart."""
    root, batches = str(tmp_path), 150
    one = make.records([("a", str(i), i, b"") for i in range(batches)])
    one.repartitionByRange(batches, "arrival_ts").write.parquet(f"{root}/log")

    def run():
        times = BatchTimes(spark, f"{root}/times")
        runner.run_to_end(
            handoff.start_handoff(
                stream_log(spark, f"{root}/log", 1),
                lambda batch, batch_id: None,
                checkpoint=f"{root}/checkpoint",
                times=times,
            )
        )
        times.close()
        return batch_samples(spark, f"{root}/times")

    found = run().groupBy("shard_id", "metric").agg(F.count("*"), F.min("value") >= 0)
    assert rows(found) == [("a", m, batches, True) for m in ("fetch", "lag", "process")]
    both = make.records([("a", "900", 900, b""), ("b", "1", 890, b"")]).coalesce(1)
    both.write.mode("append").parquet(f"{root}/log")
    found = run()
    assert rows(found.filter("metric = 'lag' AND value > 0"), "shard_id", "value") == [("b", 10_000.0)]
    assert found.filter("shard_id = 'a' AND metric = 'fetch'").count() == batches + 1


def test_stream_from_frozen_tips(spark, make, consumer):
    consumer.push(make.records([("a", "1", 1, b"")]))
    tips_path = f"{consumer.root}/tips"
    positions.freeze_tips(read_log(spark, consumer.log), tips_path)

    def run():
        log = stream_log(spark, consumer.log)
        tips = positions.freeze_tips(read_log(spark, consumer.log), tips_path)
        runner.run_to_end(
            runner.append_to_table(
                positions.after_tips(log, tips), consumer.out, f"{consumer.root}/checkpoint"
            )
        )

    consumer.push(make.records([("a", "2", 2, b"")]))
    run()
    consumer.push(make.records([("a", "3", 3, b"")]))
    run()
    out = spark.read.parquet(consumer.out)
    assert rows(out, "sequence_number") == [("2",), ("3",)]


class Recorder(handoff.ShardProcessor):
    """Tells for each record how many inits and batches came before it."""

    def __init__(self):
        self.inits = 0

    def init(self, shard_id):
        self.inits += 1
        self.shard_id, self.seen = shard_id, 0

    def process(self, batch):
        assert set(batch["shard_id"]) == {self.shard_id}
        order = range(self.seen, self.seen + len(batch))
        self.seen += len(batch)
        return pd.DataFrame(
            {"shard_id": batch["shard_id"], "seq": batch["sequence_number"], "nth": list(order)}
        )


SCHEMA = "shard_id string, seq string, nth bigint"


def _mixed(make, n=300):
    data = [("hot" if i % 3 else "cold", str(i), i, b"p") for i in range(n)]
    return make.records(sorted(data, key=lambda r: hash(r[1])))


def _by_shard(n=300):
    return {
        "hot": [i for i in range(n) if i % 3],
        "cold": [i for i in range(n) if not i % 3],
    }


def test_ordered_handoff_of_whole_shards(make):
    result = handoff.handoff_ordered(_mixed(make), Recorder, SCHEMA, whole_shards=True, partitions=2)
    for shard, numbers in _by_shard().items():
        got = sorted((r.nth, int(r.seq)) for r in result.collect() if r.shard_id == shard)
        assert got == list(enumerate(numbers))


class Positions(Recorder):
    def process(self, batch):
        out = super().process(batch)
        assert list(batch["position"]) == sorted(batch["position"])
        return out.assign(position=list(batch["position"]))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_ordered_handoff_of_stretches(make, digits):
    result = handoff.handoff_ordered(
        _mixed(make), Positions, SCHEMA + ", position bigint", digits=digits
    ).collect()
    for shard, numbers in _by_shard().items():
        got = sorted((r.position, int(r.seq)) for r in result if r.shard_id == shard)
        assert got == list(enumerate(numbers, start=1))
        # Inside a stretch the records came in order, from the first one on.
        stretch = {n: f"{len(str(n)):08d}{n}"[:-digits] for n in numbers}
        for r in (r for r in result if r.shard_id == shard):
            mine = int(r.seq)
            assert r.nth == sum(stretch[n] == stretch[mine] and n < mine for n in numbers)


def test_ordered_handoff_keeps_only_wanted_columns(make):
    class Columns(handoff.ShardProcessor):
        def process(self, batch):
            return pd.DataFrame({"names": [",".join(batch.columns)]})

    result = handoff.handoff_ordered(_mixed(make), Columns, "names string", columns=["data"])
    assert {r.names for r in result.collect()} == {"data"}


def test_ordered_handoff_times_each_call(make):
    class Quiet(handoff.ShardProcessor):
        def process(self, batch):
            return None

    timings = handoff.handoff_ordered(_mixed(make), Quiet)
    assert {(r.shard_id, r.metric) for r in timings.collect()} == {("hot", "process"), ("cold", "process")}


def test_ordered_handoff_of_nothing(make):
    assert handoff.handoff_ordered(make.records([]), Recorder, SCHEMA).count() == 0


def test_ordered_handoff_inside_a_stream(spark, make, consumer):
    consumer.push(_mixed(make))

    def process(batch, batch_id):
        ordered = handoff.handoff_ordered(batch, Recorder, SCHEMA, whole_shards=True)
        ordered.write.mode("append").parquet(consumer.out)

    consumer.run(process)
    out = spark.read.parquet(consumer.out)
    assert sorted((r.nth, int(r.seq)) for r in out.filter("shard_id = 'cold'").collect()) == list(
        enumerate(_by_shard()["cold"])
    )


def _stream_and_batch(spark, make, consumer, seconds=range(0, 7200, 45)):
    consumer.push(make.records([("ab"[n % 2], str(n), s, b"xy") for n, s in enumerate(seconds)]))
    return stream_log(spark, consumer.log), read_log(spark, consumer.log)


def _run(spark, consumer, result):
    runner.run_to_end(
        runner.append_to_table(result, consumer.out, f"{consumer.root}/checkpoint")
    )
    return spark.read.schema(result.schema).parquet(consumer.out)


def test_stream_windows_equal_batch_on_closed_windows(spark, make, consumer):
    stream, batch = _stream_and_batch(spark, make, consumer)
    found = _run(
        spark, consumer, windows.stream_throughput_by_interval(stream, "10 minutes", "5 minutes")
    )
    whole = intervals.throughput_by_interval(batch, "10 minutes")
    watermark = F.lit(at(7155 - 300)).cast("timestamp")
    assert rows(found) == rows(whole.filter(F.col("window_end") <= watermark))
    assert found.count() == 22


def test_stream_sessions_equal_batch_on_closed_sessions(spark, make, consumer):
    seconds = [0, 10, 20, 25, 300, 310, 900, 910, 915, 3000]
    stream, batch = _stream_and_batch(spark, make, consumer, seconds)
    found = _run(spark, consumer, windows.stream_sessions(stream, 60, "1 minute"))
    closed = activity_sessions(batch, 60).filter(
        F.col("session_end") <= F.lit(at(2940)).cast("timestamp")
    )
    assert rows(found) == rows(closed)
    assert found.count() == 6


def test_stream_totals_go_on_over_restarts(spark, make, consumer):
    for second in (1, 2, 3):
        consumer.push(make.records([("a", str(second), second, b"abcd")]))
        totals = windows.stream_totals(stream_log(spark, consumer.log))
        runner.run_to_end(
            runner.keep_newest(totals, consumer.out, f"{consumer.root}/checkpoint")
        )
        newest = runner.read_newest(spark, consumer.out, totals.schema)
        assert rows(newest, "n_records", "n_bytes") == [(second, 4 * second)]
    assert rows(newest) == rows(counters.throughput(read_log(spark, consumer.log)))


@pytest.mark.parametrize("hot", [True, False])
def test_stream_drops_repeats_across_batches(spark, make, consumer, hot):
    consumer.push(make.records([("a", "1", 1, b"x")] * 50))
    consumer.push(make.records([("a", "1", 1, b"x"), ("a", "2", 2, b"x")]))
    stream = stream_log(spark, consumer.log, max_files_per_trigger=1)
    found = _run(spark, consumer, windows.stream_drop_duplicates(stream, "1 hour", hot))
    assert rows(found, "sequence_number") == [("1",), ("2",)]


def test_start_at_the_tips_and_resume(spark, make, consumer, tmp_path):
    """Shards with progress resume, others begin at the tips of the first start."""
    consumer.push(make.records([("a", "1", 1, b""), ("a", "2", 1, b""), ("b", "1", 1, b"")]))
    table.add_updates(
        spark.createDataFrame([("s", "a", "1")], "stream string, shard_id string, sequence_id string"),
        consumer.progress, 0, "w",
    )
    for q in ("2", "3"):
        log = read_log(spark, consumer.log)
        consumer.run(resume=True, position=positions.LATEST, log=log)
        consumer.push(make.records([("b", q, 2, b""), ("c", q, 2, b"")]))
    consumer.run(resume=True, position=positions.LATEST, log=log)
    out = spark.read.parquet(consumer.out)
    assert rows(out, "shard_id", "sequence_number") == [("a", "2"), ("b", "2"), ("b", "3"), ("c", "2"), ("c", "3")]
    with pytest.raises(ValueError, match="batch read"):
        consumer.run(position=positions.LATEST)


def test_stop_ends_while_data_keeps_coming(spark, make, consumer):
    """The batch in progress is finished, and a restart goes on after it."""
    source = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    raw = source.selectExpr(
        "'s' AS stream", "'a' AS shard_id", "cast(value AS string) AS sequence_number",
        "format_string('%08d%d', length(cast(value AS string)), value) AS seq_key",
        "'k' AS partition_key", "cast('' AS binary) AS data", "timestamp AS arrival_ts",
    )
    begun, ended = [], []

    def slow(batch, batch_id):
        begun.append(batch_id)
        time.sleep(0.5)
        batch.write.mode("append").parquet(consumer.out)
        ended.append(batch_id)

    for _ in range(2):
        query = handoff.start_handoff(
            raw, slow, checkpoint=f"{consumer.root}/checkpoint", progress_path=consumer.progress,
            writer="w", processingTime="0 seconds",
        )
        least = len(ended) + 2
        while len(ended) < least and query.isActive:
            time.sleep(0.05)
        began = time.monotonic()
        runner.stop(query)
        assert not query.isActive and time.monotonic() - began < 30
    assert begun == sorted(begun)
    out = spark.read.parquet(consumer.out)
    done = out.agg(F.max(F.col("sequence_number").cast("bigint"))).scalar()
    stored = int(consumer.stored()[0][1])
    assert stored <= out.select(done).first()[0]
    assert rows(duplicate_deliveries(out)) == [] or len(begun) > len(set(begun))


def test_a_failed_query_is_told_while_waiting_for_a_batch(make, consumer):
    consumer.push(make.records([("a", "1", 1, b"")]))

    def fail(batch, batch_id):
        raise ValueError("no")

    query = handoff.start_handoff(
        stream_log(consumer.spark, consumer.log), fail, checkpoint=f"{consumer.root}/checkpoint"
    )
    with pytest.raises(Exception, match="no"):
        runner.after_batch(query)


def test_ordered_hand_off_sorts_the_records_once_in_short_stretches(make, capsys):
    class Starts:
        def init(self, shard_id):
            self.starts = getattr(self, "starts", 0) + 1

        def process(self, batch):
            return pd.DataFrame({"position": batch["position"], "starts": self.starts})

        def shutdown(self):
            pass

    recs = make.records([("a", str(10_000 + i), i, b"x") for i in range(300)])
    result = handoff.handoff_ordered(
        recs, Starts, "position bigint, starts bigint", columns=["position"], target_records=50
    )
    result.explain()
    plan = capsys.readouterr().out
    assert sum("Sort [" in line and "seq_key" in line for line in plan.splitlines()) == 1
    found = result.collect()
    assert sorted(r.position for r in found) == list(range(1, 301))
    assert max(r.starts for r in found) > 1
    spread = handoff.handoff_ordered(
        recs, Starts, "position bigint, starts bigint", columns=["position"], target_records=50, partitions=3
    ).collect()
    assert sorted(r.position for r in spread) == list(range(1, 301))
