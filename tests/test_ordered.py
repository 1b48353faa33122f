"""Ordered live hand-off, and pushes that fail."""

import random

import pandas as pd
from conftest import at, rows
from pyspark.sql import functions as F

from shardbrook.operators import publish
from shardbrook.streaming import push, runner
from shardbrook.streaming.ordered import handoff_live

OUT = "shard_id string, seq string, position bigint, seen bigint, inits bigint, note string"


class Remembers:
    """Counts what it has seen in attributes, over all batches and restarts."""

    def init(self, shard_id):
        self.shard_id, self.seen = shard_id, 0
        self.inits = getattr(self, "inits", 0) + 1

    def process(self, batch):
        out = pd.DataFrame({"shard_id": self.shard_id, "seq": batch["sequence_number"], "position": batch["position"]})
        out["seen"] = range(self.seen + 1, self.seen + 1 + len(batch))
        self.seen += len(batch)
        out["inits"], out["note"] = self.inits, ""
        return out

    def shutdown(self):
        assert self.seen


class Live:
    def __init__(self, spark, make, root, **options):
        self.spark, self.make, self.root, self.options = spark, make, root, options

    def push(self, pushed):
        """Rows of (shard, number, second), perhaps with an end mark; in one file, in this order."""
        table = self.make.records([(s, str(q), t, b"") for s, q, t, *_ in pushed])
        marks = {(s, str(q)): bool(m and m[0]) for s, q, _, *m in pushed}
        mark = F.udf(lambda s, q: marks[(s, q)], "boolean")
        table = table.withColumn("last", mark("shard_id", "sequence_number"))
        table.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        raw = self.spark.readStream.schema(table.schema).parquet(f"{self.root}/log")
        live = handoff_live(raw, Remembers, OUT, "10 seconds", **self.options)
        runner.run_to_end(runner.append_to_table(live, f"{self.root}/out", f"{self.root}/checkpoint"))
        out = self.spark.read.schema(OUT).parquet(f"{self.root}/out")
        return [(r.shard_id, r.seq) for r in out.orderBy("shard_id", "position").collect()]


def test_records_wait_until_their_turn(spark, make, tmp_path):
    live = Live(spark, make, str(tmp_path))
    assert live.push([("a", 9, 5), ("a", 11, 8), ("a", 10, 7)]) == []
    # The watermark is at 6: one record may go.
    assert live.push([("b", 1, 16)]) == [("a", "9")]
    # A late one in between; all of it comes in order.
    assert live.push([("a", 12, 9), ("a", 10, 7), ("b", 2, 30)]) == [("a", s) for s in ("9", "10", "11", "12")] + [("b", "1")]
    found = spark.read.schema(OUT).parquet(f"{tmp_path}/out").filter("shard_id = 'a'")
    assert rows(found, "position", "seen", "inits") == [(i, i, 1) for i in range(1, 5)]


def test_shuffled_files_and_restarts(spark, make, tmp_path):
    rng = random.Random(3)
    live = Live(spark, make, str(tmp_path))
    log = [(s, q, q) for q in range(1, 160) for s in "abc"]
    for part in range(4):
        here = [r for r in log if r[2] // 40 == part]
        rng.shuffle(here)
        live.push(here + rng.sample(here, 20))  # some are delivered twice
    found = live.push([("z", 1, 500)])
    assert found == [(s, str(q)) for s in "abc" for q in range(1, 160)]
    out = spark.read.schema(OUT).parquet(f"{tmp_path}/out")
    assert out.filter("position <> seen OR inits <> 1 OR cast(seq AS bigint) <> position").count() == 0


def test_an_ended_shard_is_shut_down_once(spark, make, tmp_path):
    live = Live(spark, make, str(tmp_path), ends="last")
    assert live.push([("a", 2, 2, True), ("a", 1, 1), ("b", 1, 3)]) == []
    assert live.push([("b", 2, 20)]) == [("a", "1"), ("a", "2"), ("b", "1")]
    # Nothing comes after the end, and the processor does not begin anew.
    found = live.push([("a", 3, 21), ("b", 3, 50), ("b", 4, 90)])
    assert [f for f in found if f[0] == "a"] == [("a", "1"), ("a", "2")]


def _long(spark, second, values):
    per_shard = spark.createDataFrame(
        [("s", shard, n, 2 * n, 1, 5.0, 5.0, 5.0, *[0, 0.0, 0.0, 0.0] * 2) for shard, n in values.items()],
        "stream string, shard_id string, n_records bigint, n_bytes bigint, "
        + ", ".join(
            f"{m}_{s} {'bigint' if s == 'sample_count' else 'double'}"
            for m in ("lag", "fetch", "process")
            for s in ("sample_count", "sum", "maximum", "minimum")
        ),
    ).withColumn("window_end", F.lit(at(second)))
    leases = spark.createDataFrame(
        [("s", shard, "w", 1, n) for shard, n in values.items()],
        "stream string, shard_id string, worker string, n_renewals bigint, leases_held bigint",
    ).withColumn("window_end", F.lit(at(second)))
    return publish.metrics_long(per_shard, leases, "window_end")


def test_what_a_service_refuses_is_pushed_later_and_once(spark, tmp_path):
    path = str(tmp_path)

    def taking(*refused):
        def take(part):
            if {e["value"] for r in part["labels"] for e in r} & set(refused):
                raise OSError("not now")

        return take

    def run(number, push_it, values):
        return push.push_interval(_long(spark, number, values), push_it, path, number, rows_per_push=1)

    run(0, taking("b"), {"a": 1, "b": 10})
    assert push.waiting_rows(spark, path).count() == 7
    run(0, taking(), {"a": 1, "b": 10})  # a replay of a stored interval pushes nothing
    assert push.waiting_rows(spark, path).count() == 7
    run(1, taking("b", "c"), {"a": 2, "b": 20, "c": 5})
    run(2, taking(), {"a": 3})  # b and c are silent, and what waits goes all the same
    assert push.waiting_rows(spark, path).count() == 0
    taken = push.pushed_rows(spark, path)
    shard = F.expr("filter(labels, e -> e.key = 'shard')[0].value").alias("shard")
    sums = taken.filter("metric = 'RecordsProcessed'").groupBy(shard).agg(F.sum("value"))
    assert rows(sums) == [("a", 6.0), ("b", 30.0), ("c", 5.0)]
    late = taken.filter(F.col("ts") == at(1)).select("metric", shard, "value", "sample_count", "maximum")
    assert rows(late.filter("shard = 'b' AND metric IN ('CurrentLeases', 'RenewLease.Success')"), "value") == [(2.0,), (20.0,)]
    assert rows(late.filter("shard = 'b' AND metric = 'MillisBehindLatest'"), "sample_count", "maximum") == [(2.0, 5.0)]
    assert taken.filter("metric LIKE 'Kinesis%' AND (maximum <> 0 OR sample_count <> 0)").count() == 0


def test_pushing_a_stream(spark, tmp_path):
    path = str(tmp_path)
    schema = _long(spark, 0, {"a": 1}).schema

    def refuse(part):
        raise OSError("down")

    for number, push_it in enumerate((refuse, refuse, lambda part: None)):
        _long(spark, number, {"a": 1, "b": 2}).write.mode("append").parquet(f"{path}/in")
        long = spark.readStream.schema(schema).parquet(f"{path}/in")
        runner.run_to_end(push.start_push(long, push_it, f"{path}/out", f"{path}/checkpoint"))
    total = push.pushed_rows(spark, f"{path}/out").filter("metric = 'RecordsProcessed'")
    assert rows(total.select("value")) == [(3.0,), (6.0,)]
    assert push.waiting_rows(spark, f"{path}/out").count() == 0
