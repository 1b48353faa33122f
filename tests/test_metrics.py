import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shardbrook.functions.measures import whole_millis
from shardbrook.functions.sequence import time_key
from shardbrook.operators import counters, intervals, publish, running, samples
from shardbrook.sources import sinks


def test_missing_payload_counts_as_empty(make):
    recs = make.records([("a", "1", 1, b"abcd"), ("a", "2", 2, None)])
    assert rows(counters.bytes_processed(recs)) == [("s", "a", 4)]
    assert rows(counters.records_processed(recs)) == [("s", "a", 2)]


def test_payload_size_is_in_bytes(make):
    assert rows(counters.bytes_processed(make.records([("a", "1", 1, "é".encode())]))) == [("s", "a", 2)]


def test_whole_millis_drops_the_fraction(spark):
    df = spark.createDataFrame([(1_999_999,), (2_000_000,), (999_999,)], "n bigint")
    assert [r[0] for r in df.select(whole_millis("n")).collect()] == [1.0, 2.0, 0.0]


def test_lag(make):
    recs = make.records([("a", "1", 1, b""), ("a", "2", 5, b""), ("b", "1", 7, b"")])
    assert rows(counters.lag_latest(recs), "shard_id", "lag_us") == [("a", 2_000_000), ("b", 0)]


def test_lag_within_each_stream(make):
    recs = make.records([("a", "1", 1, b"")], "x").unionByName(
        make.records([("a", "1", 5, b""), ("b", "1", 9, b"")], "y")
    )
    found = rows(counters.lag_latest(recs), "stream", "shard_id", "lag_us")
    assert found == [("x", "a", 0), ("y", "a", 4_000_000), ("y", "b", 0)]


def test_statistics(make):
    data = make.samples([("a", 1, "lag", 3), ("a", 2, "lag", 5), ("a", 70, "lag", 1)])
    whole = rows(samples.sample_stats(data), "sample_count", "sum", "maximum", "minimum")
    assert whole == [(3, 9.0, 5.0, 1.0)]
    minutes = rows(samples.sample_stats(data, "60 seconds"), "window_start", "sample_count", "sum")
    assert minutes == [(at(0), 2, 8.0), (at(60), 1, 1.0)]


def test_shards_without_samples_show_zeros(spark, make):
    shards = spark.createDataFrame([("s", "a"), ("s", "idle")], "stream string, shard_id string")
    data = make.samples([("a", 1, "lag", -3), ("a", 130, "lag", 5)])
    dense = samples.sample_stats_dense(shards, data, 60)
    columns = ("shard_id", "window_start", "window_end", "sample_count", "sum", "maximum", "minimum")
    zero = (0, 0.0, 0.0, 0.0)
    assert rows(dense, *columns) == [
        ("a", at(0), at(60), 1, -3.0, -3.0, -3.0),
        ("a", at(60), at(120), *zero),
        ("a", at(120), at(180), 1, 5.0, 5.0, 5.0),
        ("idle", at(0), at(180), *zero),
    ]
    none = samples.sample_stats_dense(shards, data.limit(0), 60)
    assert rows(none, *columns) == [("a", None, None, *zero), ("idle", None, None, *zero)]


def test_histogram_is_cumulative_and_inclusive(make):
    data = make.samples([("a", 1, "fetch", v) for v in (0.005, 0.3, 1, 50)])
    found = {r.le: r.cum_count for r in samples.sample_histogram(data).collect()}
    assert len(found) == len(samples.DEFAULT_BUCKETS) + 1
    assert (found[0.005], found[0.25], found[0.5], found[1.0], found[10.0]) == (1, 1, 2, 3, 3)
    assert found[float("inf")] == 4


def test_running_gauge(make):
    events = make.leases(
        [
            (1, "a", "w", 0, "gained"),
            (2, "a", "w", 10, "gained"),
            (3, "a", "w", 3600, "lost"),
            (4, "a", "w", 3600, "gained"),
            (5, "a", "w", 9000, "lost"),
            (6, "a", "v", 5, "lost"),
            (7, "a", "w", 20, "renewed"),
        ]
    )
    found = rows(running.leases_held(events), "event_id", "leases_held")
    assert found == [(1, 1), (2, 2), (3, 1), (4, 2), (5, 1), (6, -1)]


@pytest.mark.parametrize("seed", range(3))
def test_running_total_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("aaab"), i, rng.randint(0, 500), rng.randint(-5, 5)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, id bigint, t int, v int")
    found = running.running_total(
        df, ["k"], ["t", "id"], F.col("v"), F.floor(F.col("t") / 37), "total"
    )
    expected, sums = [], {}
    for k, i, t, v in sorted(data, key=lambda r: (r[2], r[1])):
        sums[k] = sums.get(k, 0) + v
        expected.append((i, sums[k]))
    assert sorted((r.id, r.total) for r in found.collect()) == sorted(expected)


def test_event_counter(make):
    events = make.leases([(1, "a", "w", 0, "renewed"), (2, "a", "w", 1, "renewed"), (3, "b", "w", 1, "lost")])
    assert rows(counters.event_counts(events), "shard_id", "n_events") == [("a", 2), ("b", 0)]


def test_counts_restart_with_each_interval_but_leases_do_not(make):
    recs = make.records([("a", "1", 1, b"ab"), ("a", "2", 2, b"c"), ("a", "3", 61, b"d")])
    found = rows(intervals.throughput_by_interval(recs), "window_start", "n_records", "n_bytes")
    assert found == [(at(0), 2, 3), (at(60), 1, 1)]
    leases = make.leases([(1, "a", "w", 1, "gained"), (2, "a", "w", 2, "renewed"), (3, "a", "w", 61, "renewed")])
    found = rows(intervals.lease_metrics(leases), "window_start", "n_renewals", "leases_held")
    assert found == [(at(0), 1, 1), (at(60), 1, 1)]


def _long(make):
    recs = make.records([("00001", str(i), i, b"abcd") for i in range(10)] + [("00002", "1", 1, b"")])
    data = make.samples([("00001", 1, "fetch", 4), ("00001", 2, "fetch", 6)])
    leases = make.leases([(1, "00001", "abc123", 1, "gained")])
    per_shard = intervals.shard_metrics(recs, data)
    return publish.metrics_long(per_shard, intervals.lease_metrics(leases), "window_end")


def test_long_metrics_cover_all_shards(make):
    long = _long(make)
    assert long.count() == 2 * 5 + 2
    flat = publish.flat_metrics(long)
    one = "KinesisStreamName=s,shard=00001"
    value = {(r.metric, r.dims): r for r in flat.collect()}
    assert value["RecordsProcessed", one].value == 10.0
    assert value["DataBytesProcessed", one].value == 40.0
    fetch = value["KinesisDataFetcher.getRecords.Time", one]
    assert (fetch.value, fetch.sample_count, fetch.sum, fetch.maximum, fetch.minimum) == (None, 2, 10, 6, 4)
    assert value["MillisBehindLatest", one].sample_count == 0
    held = value["CurrentLeases", "KinesisStreamName=s,WorkerID=abc123,shard=00001"]
    assert (held.value, held.unit, held.sample_count) == (1.0, "Count", None)


def test_long_metrics_are_stored(spark, make, tmp_path):
    sinks.write_metrics(_long(make), str(tmp_path))
    sinks.write_metrics(_long(make), str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).count() == 24


def test_exposition(spark, make, tmp_path):
    recs = make.records([("a", "1", 1, b"abcd"), ('b"\\', "1", 3, b"")])
    totals = counters.with_lag(counters.throughput(recs)).withColumn("lag_ms", F.col("lag_us") / 1000)
    leases = intervals.lease_metrics(make.leases([(1, "a", "w", 1, "gained")]), None)
    hist = samples.sample_histogram(make.samples([("a", 1, "fetch", 0.5), ("a", 1, "lag", 1)]), [0.1, 1])
    sinks.write_exposition(publish.exposition(totals, leases, hist, "ns"), str(tmp_path / "m"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert 'ns_processed_bytes{kinesisStream="s",shard="a"} 4' in lines
    assert 'ns_processed_records{kinesisStream="s",shard="b\\"\\\\"} 1' in lines
    assert 'ns_behind_latest_millis{kinesisStream="s",shard="a"} 2000' in lines
    assert 'ns_leases_held{kinesisStream="s",shard="a",workerID="w"} 1' in lines
    family = [x for x in lines if "get_records_duration" in x]
    label = '{kinesisStream="s",shard="a"'
    name = "ns_get_records_duration_milliseconds"
    assert family == [
        f"# HELP {name} Time to fetch and process a batch",
        f"# TYPE {name} histogram",
        f'{name}_bucket{label},le="0.1"}} 0',
        f'{name}_bucket{label},le="1"}} 1',
        f'{name}_bucket{label},le="+Inf"}} 1',
        f"{name}_sum{label}}} 0.5",
        f"{name}_count{label}}} 1",
    ]
    # Every family is one block that starts with its help line.
    assert [x.split()[2] for x in lines if x.startswith("# HELP")] == [
        f"ns_{f}" for f in publish.FAMILIES
    ]


def test_publish_chooses_by_service_name(make):
    long = _long(make)
    assert publish.publish(None, long=long) is None
    assert publish.publish("cloudwatch", long=long) is long
    with pytest.raises(ValueError, match="unknown monitoring service"):
        publish.publish("statsd", long=long)


FIRST = 49590338271490256608559692538361571095921575989136588898


def _stretches(recs, target):
    """Sizes of the stretches, with positions checked against plain order."""
    numbered = running.shard_positions(recs, target_records=target).collect()
    by_shard = {}
    for r in numbered:
        by_shard.setdefault(r.shard_id, []).append((int(r.sequence_number), r.position))
    for found in by_shard.values():
        assert [p for _, p in sorted(found)] == list(range(1, len(found) + 1))
    sizes = {}
    for r in numbered:
        sizes[r.shard_id, r._stretch] = sizes.get((r.shard_id, r._stretch), 0) + 1
    return list(sizes.values())


@pytest.mark.parametrize("gap", [1, 10**30])
def test_stretches_suit_sparse_and_dense_numbers(make, gap):
    recs = make.records([("a", str(FIRST + i * gap), i, b"") for i in range(200)])
    sizes = _stretches(recs, 20)
    assert max(sizes) <= 40 and len(sizes) <= 210


def test_stretches_of_a_burst_and_of_shards_with_other_spacing(make):
    """A burst of neighbours far from the rest, and a sparse shard beside a dense one."""
    burst = [("a", str(FIRST + i), i, b"") for i in range(150)]
    burst += [("a", str(FIRST + 10**40 + i * 10**38), i, b"") for i in range(30)]
    sparse = [("b", str(i * 10**9), i, b"") for i in range(100)]
    short = [("c", str(i), i, b"") for i in range(5)]
    sizes = _stretches(make.records(burst + sparse + short), 20)
    assert max(sizes) <= 40 and len(sizes) <= 80


def test_shard_metrics_in_total(make):
    recs = make.records([("a", "1", 1, b"abcd"), ("a", "2", 100, b"ab")])
    data = make.samples([("a", 1, "lag", 4), ("b", 200, "process", 6)])
    total = intervals.shard_metrics(recs, data, None)
    columns = ("shard_id", "n_records", "n_bytes", "lag_sum", "fetch_sample_count", "process_maximum")
    assert rows(total, *columns) == [("a", 2, 6, 4.0, 0, 0.0), ("b", 0, 0, 0.0, 0, 6.0)]


def test_positions_with_a_missing_key(spark, make):
    from shardbrook.operators.running import shard_positions

    recs = make.records([("a", None, 1, b""), ("a", "1", 2, b""), ("a", "2", 3, b"")])
    found = shard_positions(recs, digits=1)
    assert rows(found, "sequence_number", "position") == [("1", 2), ("2", 3), (None, 1)]


def test_large_counters_keep_every_digit(spark):
    from pyspark.sql import functions as F

    from shardbrook.operators.publish import _number

    df = spark.sql("SELECT 9007199254740993L AS big, 1234567890123457D AS whole, 0.5D AS part")
    found = df.select(*(_number(F.col(c)).alias(c) for c in df.columns)).first()
    assert tuple(found) == ("9007199254740993", "1234567890123457", "0.5")


def test_lag_of_very_many_streams(spark):
    """A hundred thousand streams of three shards, and shards of no stream."""
    per_shard = spark.range(300_000).selectExpr(
        "concat('s', id % 100000) AS stream", "cast(id AS string) AS shard_id",
        "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id div 100000) AS last_arrival",
    )
    none = spark.range(1).selectExpr("cast(NULL AS string) AS stream", "'x' AS shard_id", "timestamp '2024-01-01' AS last_arrival")
    found = counters.with_lag(per_shard.union(none))
    assert rows(found.groupBy("lag_us").count()) == [(0, 100_000), (1_000_000, 100_000), (2_000_000, 100_000), (None, 1)]


def test_the_newest_sample_is_the_gauge(make):
    found = make.samples([("a", 2, "lag", 5), ("a", 9, "lag", 1), ("a", 9, "fetch", 7), ("b", 1, "lag", 2)])
    assert rows(counters.lag_gauge(found), "shard_id", "value") == [("a", 1.0), ("b", 2.0)]


def test_repeated_and_missing_keys_are_cut(spark, make):
    """A thousand records of one key and 990 of none, alike in all columns, beside others."""
    same = [("a", "500", 1, b"x")] * 1000 + [("a", str(n), 1, b"") for n in range(400, 600)]
    none = [("a", None, 1, b"x")] * 990 + [(None, str(n), 1, b"") for n in range(100, 300)]
    recs = make.records(same + none + [("b", "7", 1, b"")])
    numbered = running.shard_positions(recs, target_records=10).collect()
    sizes, by_shard = {}, {}
    for r in numbered:
        sizes[r.shard_id, r._stretch] = sizes.get((r.shard_id, r._stretch), 0) + 1
        number = -1 if r.sequence_number is None else int(r.sequence_number)
        by_shard.setdefault(r.shard_id, []).append((r.position, number))
    assert max(sizes.values()) <= 20 and len(sizes) >= 200
    for found in by_shard.values():
        found.sort()
        assert [p for p, _ in found] == list(range(1, len(found) + 1))
        assert [n for _, n in found] == sorted(n for _, n in found)
    assert len(by_shard["a"]) == 2190 and len(by_shard[None]) == 200


def test_a_burst_of_one_worker_is_many_stretches(spark, make):
    """All in one hour, many at one moment; the gauge as one walk through time gives it."""
    rng = random.Random(2)
    moves = [
        (i, "a", "w", rng.choice([5, 5, 5, rng.randrange(3600)]), rng.choice(["gained", "lost"]))
        for i in range(1500)
    ] + [(5000 + i, "b", "w", i * 50_000, "gained") for i in range(30)]
    events = make.leases(moves)
    keyed = events.withColumn("_key", time_key("ts", "event_id"))
    by = ["stream", "shard_id", "worker"]
    sizes = running.in_stretches(keyed, 20, by, "_key").groupBy(*by, "_stretch").count().collect()
    assert max(r["count"] for r in sizes) <= 40
    found = {r.event_id: r.leases_held for r in running.leases_held(events, 20).collect()}
    held, wanted = {}, {}
    for i, shard, worker, second, kind in sorted(moves, key=lambda m: (m[3], m[0])):
        held[shard] = held.get(shard, 0) + (1 if kind == "gained" else -1)
        wanted[i] = held[shard]
    assert found == wanted
