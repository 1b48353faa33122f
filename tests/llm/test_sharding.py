import random
import zlib

import pytest
from pyspark.sql import functions as F

from shardbrook.llm.queries import LLM_QUERIES
from shardbrook.llm.ranges import in_ranges, sort_key
from shardbrook.llm.sharding import shard_documents, shard_rows, write_shards
from shardbrook.storage import store

SF_DIR = "/root/testdata/sf0.001"


def _checked(found, largest):
    """Slots without gaps, and shards that differ by less than the largest row."""
    loads, slots = {}, {}
    for row in found:
        loads[row.shard] = loads.get(row.shard, 0) + row.size
        slots.setdefault(row.shard, []).append(row.slot)
    for taken in slots.values():
        assert sorted(taken) == list(range(len(taken)))
    assert max(loads.values()) - min(loads.values()) <= largest
    return loads


def test_registered_query_over_its_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = LLM_QUERIES["op11_sharding"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for row in found:
        text = docs[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(text) + 1, zlib.crc32(text))
        assert row.law == "bytes" and row.grown_shard is None
    assert set(_checked(found, max(r.size for r in found))) == set(range(8))


def test_odd_rows(documents):
    rng = random.Random(3)
    texts = [None, "", "é" * 5, "a" * 90_000]
    texts += ["x" * rng.randint(1, 400) + str(i) for i in range(2000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, texts[7])]
    rows += [(5000, "the same text")] * 1500
    docs = documents(rows).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS _key", "4 AS size")
    found = shard_documents(docs, keep=("lang",)).collect()
    assert sorted((r.doc_id or -1) for r in found) == sorted((i or -1) for i, _ in rows)
    loads = _checked(found, 90_001)
    # One row is more than a shard's part; the others share the rest.
    rest = sorted(loads.values())[:-1]
    assert max(rest) - min(rest) < 0.01 * max(rest)
    sizes = {i: len((t or "").encode()) + 1 for i, t in rows}
    assert all(r.size == sizes[r.doc_id] for r in found)
    assert len({r.shard for r in found if r.doc_id == 5000}) > 1
    assert shard_documents(docs.limit(0)).count() == 0


def test_small_groups_stay_together(documents):
    rng = random.Random(5)
    docs = documents([f"text {rng.randrange(1500)}" for _ in range(6000)])
    found = shard_documents(docs, shards=4, pieces=16).join(docs, "doc_id")
    assert found.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("hot", [0, 4000])
def test_no_range_is_overfull(spark, hot):
    rows = spark.range(6000).select(
        sort_key(
            F.when(F.col("id") < hot, F.lit("hot")).otherwise(F.col("id").cast("string")),
            F.col("id"),
        ).alias("_key"),
        F.when(F.col("id") == 77, 10_000_000).otherwise(F.col("id") % 50 + 1).alias("_size"),
    )
    ranges = in_ranges(store(rows, "test"), 40)
    found = ranges.groupBy("_range").agg(F.count("*").alias("n"), F.min("_key").alias("a"), F.max("_key").alias("z"))
    found = sorted(found.collect(), key=lambda r: r._range)
    assert sum(r.n for r in found) == 6000
    assert all(r.n <= 300 for r in found)
    assert [r.n for r in found if r._range < 0] == [1]
    order = [r for r in found if r._range >= 0]
    assert all(tuple(p.z) < tuple(q.a) for p, q in zip(order, order[1:]))


def test_general_keys_and_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) AS day")
    found = shard_rows(rows, lead=F.col("day"), order_by=("id",), size=F.lit(1), shards=3, pieces=8)
    write_shards(found, str(tmp_path / "out"), rows_per_file=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 3 and max(counts) - min(counts) <= 84
    by_file = back.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in by_file) <= 100
