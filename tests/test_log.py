from conftest import rows

from shardbrook.operators import positions
from shardbrook.sources.log import append_records, as_records, read_log, stream_log
from shardbrook.schema import RECORD


def test_append_and_read_back(spark, make, tmp_path):
    path = str(tmp_path / "log")
    append_records(make.records([("0001", "1", 1, b"a"), ("0002", "1", 2, b"b")]), path)
    append_records(make.records([("0001", "2", 3, b"c")]), path)
    log = read_log(spark, path)
    # Shard ids stay text although they are folder names of digits.
    assert log.schema == RECORD
    assert rows(log, "shard_id", "sequence_number") == [("0001", "1"), ("0001", "2"), ("0002", "1")]
    assert stream_log(spark, path, 1, "1g").schema == RECORD


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_stored_log(spark, make, tmp_path):
    path = str(tmp_path / "log")
    append_records(make.records([("a", str(n), n, b"") for n in range(20)]), path)
    log = read_log(spark, path)
    after = positions.after_sequence(log, "7").select("sequence_number")
    assert "GreaterThan(seq_key,000000017)" in plan(after)
    assert "data" not in plan(after).split("ReadSchema")[1]
    one = plan(log.filter("shard_id = 'a'"))
    assert "PartitionFilters: [isnotnull(shard_id" in one
    progress = make.progress([("a", "12", "w", False, None)])
    assert positions.resume(log, progress, complete=True).count() == 7


def test_small_progress_is_broadcast_and_large_is_shuffled(spark, make, tmp_path):
    path = str(tmp_path / "progress")
    make.progress([("a", "7", "w", False, None)]).write.parquet(path)
    progress = spark.read.parquet(path)
    log = make.records([("a", str(n), n, b"") for n in range(20)])
    resumed = positions.resume(log, progress)
    expected = rows(resumed, "sequence_number")
    assert "BroadcastHashJoin" in plan(resumed)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        resumed = positions.resume(log, progress)
        assert "Broadcast" not in plan(resumed)
        assert rows(resumed, "sequence_number") == expected
    finally:
        spark.conf.set(limit, before)


def test_project_any_table(spark):
    raw = spark.sql("SELECT 7 AS id, 'k' AS k, 'body' AS text, timestamp '2024-01-01' AS t")
    found = as_records(
        raw, "s", shard_id="'one'", sequence_number="cast(id AS string)", partition_key="k",
        data="encode(text, 'UTF-8')", arrival_ts="t",
    )
    assert found.schema.fieldNames() == RECORD.fieldNames()
    assert rows(found, "stream", "shard_id", "seq_key") == [("s", "one", "000000017")]


def test_scratch_tables_can_be_cleared(spark):
    from shardbrook import storage

    kept = storage.store(spark.range(3), "kept")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert storage.read_if_present(spark, path, "id bigint").count() == 3
    storage.clear_scratch(spark)
    assert storage.read_if_present(spark, path, "id bigint") is None


def test_the_core_stays_when_a_text_library_is_missing(tmp_path):
    import os
    import subprocess
    import sys

    (tmp_path / "tiktoken.py").write_text("raise ImportError('not here')")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; print(len(e.queries()), 'records_scan' in e.queries())"
    done = subprocess.run(
        [sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True,
        env=os.environ | {"PYTHONPATH": f"{tmp_path}:{root}"},
    )
    from shardbrook.plans.queries import QUERIES

    assert done.stdout.split() == [str(len(QUERIES)), "True"], done.stderr[-1000:]
