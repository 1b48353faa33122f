"""Where to start reading each shard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.functions.sequence import key_bounds, number_of, seq_key
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store, write_once

TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
AFTER_SEQUENCE_NUMBER = "AFTER_SEQUENCE_NUMBER"

TIPS_SCHEMA = "stream string, shard_id string, sequence_number string, tip_key string"


def shard_tips(records: DataFrame) -> DataFrame:
    """The last sequence number of every shard; reads the keys only."""
    tips = key_bounds(records, SHARD_KEYS).withColumnRenamed("last_key", "tip_key")
    return tips.select(*SHARD_KEYS, number_of("tip_key").alias("sequence_number"), "tip_key")


def freeze_tips(records: DataFrame, path: str | None = None) -> DataFrame:
    """Take the tips once and keep them.

    A consumer that starts at the tip needs the same tips again after a restart,
    or it would skip what arrived between.  With ``path`` (beside the stream's
    checkpoint) tips already written there are returned unchanged.
    """
    if path is None:
        return store(shard_tips(records), "tips")
    return write_once(
        records.sparkSession, path, TIPS_SCHEMA, lambda: shard_tips(records)
    )


def after_tips(records: DataFrame, tips: DataFrame) -> DataFrame:
    """Records above the frozen tips; shards born later are read whole."""
    bounds = tips.select(*SHARD_KEYS, "tip_key")
    return (
        records.join(bounds, SHARD_KEYS, "left")
        .filter(F.col("tip_key").isNull() | (F.col("seq_key") > F.col("tip_key")))
        .drop("tip_key")
    )


def after_sequence(records: DataFrame, sequence_number: str) -> DataFrame:
    """Records strictly after one sequence number.

    The bound is a literal, so on a stored log it is pushed to the scan.
    """
    return records.filter(F.col("seq_key") > seq_key(F.lit(sequence_number)))


def start_at(
    records: DataFrame,
    position: str,
    tips: DataFrame | None = None,
    sequence_number: str | None = None,
) -> DataFrame:
    """Apply a named start position."""
    if position == TRIM_HORIZON:
        return records
    if position == LATEST:
        if tips is None:
            raise ValueError("LATEST needs the tips taken at the first start")
        return after_tips(records, tips)
    if position == AFTER_SEQUENCE_NUMBER:
        if not sequence_number:
            raise ValueError("AFTER_SEQUENCE_NUMBER needs a sequence number")
        return after_sequence(records, sequence_number)
    raise ValueError(f"unknown start position: {position}")


def _checkpoint_key() -> Column:
    return seq_key(F.nullif("sequence_id", F.lit("")))


def resume(records: DataFrame, progress: DataFrame, complete: bool = False) -> DataFrame:
    """Records after each shard's checkpoint; shards without one are read whole.

    An empty checkpoint counts as none.  ``complete`` states that every shard of
    the log has a checkpoint: then no record at or below the smallest one can
    qualify, and that bound goes to the scan of a stored log ahead of the join.
    """
    bounds = progress.select(*SHARD_KEYS, _checkpoint_key().alias("ckpt_key"))
    if complete:
        records = records.filter(F.col("seq_key") > bounds.agg(F.min("ckpt_key")).scalar())
    return (
        records.join(bounds, SHARD_KEYS, "left")
        .filter(F.col("ckpt_key").isNull() | (F.col("seq_key") > F.col("ckpt_key")))
        .drop("ckpt_key")
    )


def read_between(records: DataFrame, bounds: DataFrame, groups: int = 8) -> DataFrame:
    """Records of the shards in ``bounds`` after their ``low_key`` and up to their ``high_key``.

    A null bound is none.  A shard may have several rows if they do not overlap.  On a
    stored log little else is read: the bounds are cut into ``groups`` of about equal size by
    ``low_key``, and each group is a scan of its own, with the group's smallest and largest
    key as literals for the row groups, and its shards pruning the folders.  So one shard that
    lags behind makes only its group read from far back.
    """
    columns = [*SHARD_KEYS, "low_key", "high_key"]
    # A row for each shard is ranked here, none of the log.
    tile = F.ntile(groups).over(Window.orderBy(F.asc_nulls_first("low_key")))
    dealt = store(bounds.select(*columns, tile.alias("_group")), "bounds")
    ends = dealt.groupBy("_group").agg(
        F.min("low_key").alias("low"),
        F.max("high_key").alias("high"),
        F.bool_or(F.col("low_key").isNull()).alias("from_first"),
        F.bool_or(F.col("high_key").isNull()).alias("to_last"),
    )
    scans = []
    for end in ends.orderBy("_group").collect():  # a row for each group
        part = records
        if not end["from_first"]:
            part = part.filter(F.col("seq_key") > end["low"])
        if not end["to_last"]:
            part = part.filter(F.col("seq_key") <= end["high"])
        own = dealt.filter(F.col("_group") == end["_group"]).select(*columns)
        scans.append(
            part.join(own, SHARD_KEYS)
            .filter(F.col("low_key").isNull() | (F.col("seq_key") > F.col("low_key")))
            .filter(F.col("high_key").isNull() | (F.col("seq_key") <= F.col("high_key")))
            .select(*records.columns)
        )
    return reduce(DataFrame.unionByName, scans) if scans else records.limit(0)


def resume_by_groups(
    records: DataFrame, progress: DataFrame, groups: int = 8, complete: bool = False
) -> DataFrame:
    """``resume`` of a stored log that reads little more than what is left.

    Shards without a checkpoint are looked up in the log's key columns and read whole;
    ``complete`` states that there are none.
    """
    bounds = progress.select(*SHARD_KEYS, _checkpoint_key().alias("low_key"))
    if not complete:
        found = records.select(*SHARD_KEYS).distinct().join(bounds, SHARD_KEYS, "left_anti")
        bounds = bounds.unionByName(found.withColumn("low_key", F.lit(None).cast("string")))
    return read_between(records, bounds.withColumn("high_key", F.lit(None).cast("string")), groups)


def resume_or_start(
    records: DataFrame,
    progress: DataFrame,
    position: str = TRIM_HORIZON,
    tips: DataFrame | None = None,
) -> DataFrame:
    """Checkpointed shards resume; the others begin at ``position``."""
    if position == TRIM_HORIZON:
        return resume(records, progress)
    if position != LATEST:
        raise ValueError(f"a first start can be {TRIM_HORIZON} or {LATEST}, not {position}")
    if tips is None:
        raise ValueError("LATEST needs the tips taken at the first start")
    stored = progress.select(*SHARD_KEYS, _checkpoint_key().alias("_key"))
    # A checkpoint replaces the tip of its shard.
    return (
        records.join(tips.select(*SHARD_KEYS, "tip_key"), SHARD_KEYS, "left")
        .join(stored, SHARD_KEYS, "left")
        .withColumn("_from", F.coalesce("_key", "tip_key"))
        .filter(F.col("_from").isNull() | (F.col("seq_key") > F.col("_from")))
        .drop("tip_key", "_key", "_from")
    )
