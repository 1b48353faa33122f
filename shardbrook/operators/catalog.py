"""Which shards exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardbrook.functions.sequence import key_bounds, number_of
from shardbrook.schema import SHARD_KEYS


def shard_catalog(records: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """One row per shard with its first and last sequence number and row count.

    ``parents`` (``shard_id, parent_shard_id``) adds the shard each one was
    split or merged from; shards without a row keep NULL.
    """
    catalog = key_bounds(records, SHARD_KEYS).select(
        *SHARD_KEYS,
        number_of("first_key").alias("first_sequence"),
        number_of("last_key").alias("last_sequence"),
        "n_records",
    )
    if parents is None:
        return catalog.withColumn("parent_shard_id", F.lit(None).cast("string"))
    return catalog.join(parents.select("shard_id", "parent_shard_id"), "shard_id", "left")


def list_shards(records: DataFrame) -> DataFrame:
    """The shards of a log and nothing else: reads the two key columns only."""
    return records.select(*SHARD_KEYS).distinct()


def new_shards(catalog: DataFrame, known: DataFrame) -> DataFrame:
    """Shards not seen before.  Known ones keep their state; none is removed."""
    return catalog.join(known.select(*SHARD_KEYS), SHARD_KEYS, "left_anti")
