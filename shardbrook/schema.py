"""Table layouts.  They are fixed: nothing here is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        # sequence_number in a form that sorts; stored so that a literal bound on
        # it reaches the Parquet scan.
        T.StructField("seq_key", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("arrival_ts", T.TimestampType()),
    ]
)

SHARD = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("parent_shard_id", T.StringType()),
    ]
)

PROGRESS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("lease_timeout", T.TimestampType()),
        T.StructField("parent_shard_id", T.StringType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("claim_request", T.StringType()),
    ]
)

SAMPLE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

LEASE_EVENT = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("worker", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("kind", T.StringType()),
    ]
)

# One shard of one stream; every per-shard operator groups by this pair.
SHARD_KEYS = ["stream", "shard_id"]
