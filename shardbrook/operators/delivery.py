"""At-least-once delivery: find repeats and drop them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.operators.positions import read_between
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store

IDENTITY = [*SHARD_KEYS, "sequence_number"]


def delivery_counts(deliveries: DataFrame) -> DataFrame:
    """How often each record was handed over; reads the identity columns only."""
    return deliveries.groupBy(*IDENTITY).agg(F.count("*").alias("n_delivered"))


def duplicate_deliveries(deliveries: DataFrame) -> DataFrame:
    return delivery_counts(deliveries).filter("n_delivered > 1")


def drop_duplicate_deliveries(deliveries: DataFrame) -> DataFrame:
    """Keep one copy of each record (batch input).

    Repeats are found on the identity columns alone; payloads are only brought
    together where a record came more than once.
    """
    repeated = duplicate_deliveries(deliveries).select(
        *(F.col(c).alias(f"_{c}") for c in IDENTITY)
    )
    same = F.lit(True)
    for c in IDENTITY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    once = deliveries.join(repeated, same, "left_anti")
    return once.unionByName(
        deliveries.join(repeated, same, "left_semi").dropDuplicates(IDENTITY)
    )


# Overlaps that a search can tell apart in one shard: two to the power of this.
_HALVINGS = 30


def delivered_runs(bounds: DataFrame) -> DataFrame:
    """How often each stretch of a shard was delivered: ``low_key, high_key, n_delivered``.

    ``bounds`` has a row per reader and run of records: all records of the shard after
    ``low_key`` (from the first, if null) up to ``high_key``.  Ends of runs are swept in
    order: a start adds one, an end takes one away.  A row per run, none of the log.
    """
    low = F.coalesce("low_key", F.lit(""))
    runs = bounds.filter(F.col("high_key") > low)
    ends = (
        runs.select(*SHARD_KEYS, low.alias("low_key"), F.lit(1).alias("change"))
        .union(runs.select(*SHARD_KEYS, "high_key", F.lit(-1)))
        .groupBy(*SHARD_KEYS, "low_key")
        .agg(F.sum("change").alias("change"))
    )
    in_order = Window.partitionBy(*SHARD_KEYS).orderBy("low_key")
    return (
        ends.withColumn("n_delivered", F.sum("change").over(in_order))
        .withColumn("high_key", F.lead("low_key").over(in_order))
        .filter("n_delivered > 0")
        .select(*SHARD_KEYS, "low_key", "high_key", "n_delivered")
    )


def _overlap(key: Column, overlaps: Column) -> Column:
    """The last of a shard's overlaps that begins before ``key``, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(_HALVINGS))])

    def step(at: Column, width: Column) -> Column:
        there = F.get(overlaps, at + width - 1)["low_key"]
        inside = F.when(at + width <= F.size(overlaps), there < key).otherwise(False)
        return F.when(inside, at + width).otherwise(at)

    return F.get(overlaps, F.aggregate(steps, F.lit(0), step) - 1)


def duplicate_runs(bounds: DataFrame, records: DataFrame, groups: int = 8) -> DataFrame:
    """``duplicate_deliveries`` from what readers report as done, and not from deliveries.

    ``bounds`` is as for ``delivered_runs``.  Only stretches that were delivered twice or
    more are read from the log (``read_between``); how often a record came is looked up in its
    shard's overlaps, which are joined as one sorted list, so no record is shuffled.
    """
    overlaps = store(delivered_runs(bounds).filter("n_delivered > 1"), "overlaps")
    spans = overlaps.groupBy(*SHARD_KEYS).agg(
        F.min("low_key").alias("low_key"), F.max("high_key").alias("high_key")
    )
    listed = overlaps.groupBy(*SHARD_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("low_key", "high_key", "n_delivered"))).alias("_all")
    )
    read = read_between(records.select(*IDENTITY, "seq_key"), spans, groups)
    found = read.join(listed, SHARD_KEYS).withColumn("_in", _overlap(F.col("seq_key"), F.col("_all")))
    return found.filter(F.col("seq_key") <= F.col("_in.high_key")).select(
        *IDENTITY, F.col("_in.n_delivered").alias("n_delivered")
    )
