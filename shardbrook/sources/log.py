"""The record log: read whole, read as a stream, append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardbrook.functions.sequence import seq_key
from shardbrook.schema import RECORD


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as a table; filters on shard prune folders, on seq_key row groups."""
    return spark.read.schema(RECORD).parquet(path).select(*RECORD.fieldNames())


def stream_log(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The log as a stream.  The limits bound a micro-batch, not the result."""
    reader = spark.readStream.schema(RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path).select(*RECORD.fieldNames())


def as_records(
    df: DataFrame,
    stream: str,
    shard_id: str = "shard_id",
    sequence_number: str = "sequence_number",
    partition_key: str = "partition_key",
    data: str = "data",
    arrival_ts: str = "arrival_ts",
) -> DataFrame:
    """Project any table onto the RECORD layout; arguments are SQL expressions."""
    return df.select(
        F.lit(stream).alias("stream"),
        F.expr(shard_id).alias("shard_id"),
        F.expr(sequence_number).alias("sequence_number"),
        seq_key(F.expr(sequence_number)).alias("seq_key"),
        F.expr(partition_key).alias("partition_key"),
        F.expr(data).alias("data"),
        F.expr(arrival_ts).alias("arrival_ts"),
    )


def append_records(records: DataFrame, path: str, partition_by: str = "shard_id") -> None:
    """Append to the log, one folder per shard, ordered inside each file.

    The rebalance splits a hot shard over several files and merges small ones;
    the order gives row groups narrow seq_key ranges.  With very many shards
    pass a coarser ``partition_by`` column.
    """
    (
        records.hint("rebalance", partition_by)
        .sortWithinPartitions(partition_by, "seq_key")
        .write.mode("append")
        .partitionBy(partition_by)
        .parquet(path)
    )
