"""Per-shard progress: find it, look it up, advance it, close it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardbrook.functions.sequence import key_bounds, number_of, seq_key
from shardbrook.schema import PROGRESS, SHARD_KEYS


def latest_checkpoints(records: DataFrame) -> DataFrame:
    """The last sequence number of each shard in a batch.

    No record means no row, so an empty batch moves nothing.
    """
    newest = key_bounds(records, SHARD_KEYS)
    return newest.select(*SHARD_KEYS, number_of("last_key").alias("sequence_id"))


def manual_checkpoints(records: DataFrame, where: Column) -> DataFrame:
    """Checkpoints at records the caller picks, e.g. the ends of transactions."""
    return latest_checkpoints(records.filter(where))


def lookup_checkpoints(shards: DataFrame, progress: DataFrame) -> DataFrame:
    """The stored progress of each shard; a shard without any gets ''."""
    stored = progress.select(
        *SHARD_KEYS,
        "sequence_id",
        "owner",
        "lease_timeout",
        "claim_request",
        F.col("parent_shard_id").alias("_parent"),
    )
    found = shards.join(stored, SHARD_KEYS, "left").withColumn(
        "sequence_id", F.coalesce("sequence_id", F.lit(""))
    )
    # A stored parent wins over the one in the shard list.
    if "parent_shard_id" in shards.columns:
        return found.withColumn(
            "parent_shard_id", F.coalesce("_parent", "parent_shard_id")
        ).drop("_parent")
    return found.withColumnRenamed("_parent", "parent_shard_id")


def upsert_checkpoints(
    progress: DataFrame,
    updates: DataFrame,
    writer: str | None = None,
) -> DataFrame:
    """Apply new checkpoints to the progress table and return all of it.

    ``updates`` has ``stream, shard_id, sequence_id`` and optionally ``closed`` (false if
    absent) and ``owner`` (who writes; ``writer`` if absent); of several rows for a shard the furthest counts.
    A row changes only when no claim on it is pending and its owner is the
    writer.  With no writer at all the last write wins.  A shard without a row
    is added.  A checkpoint may move backwards: nothing compares it with the
    stored one.

    Both sides hold one row per shard, so the join has no hot key.
    """
    furthest = F.max_by(F.struct(*updates.columns), seq_key("sequence_id")).alias("u")
    new = updates.groupBy(*SHARD_KEYS).agg(furthest).select("u.*").select(
        *SHARD_KEYS,
        F.lit(True).alias("_has_new"),
        F.col("sequence_id").alias("_sequence_id"),
        (F.coalesce("closed", F.lit(False)) if "closed" in updates.columns else F.lit(False))
        .alias("_closed"),
        (F.col("owner") if "owner" in updates.columns else F.lit(writer).cast("string"))
        .alias("_writer"),
    )
    old = progress.withColumn("_has_old", F.lit(True))
    has_old, has_new = F.col("_has_old").isNotNull(), F.col("_has_new").isNotNull()
    guarded = writer is not None or "owner" in updates.columns
    # A comparison with a missing owner is unknown, and must refuse.
    allowed = (
        F.coalesce(
            F.col("claim_request").isNull() & (F.col("owner") == F.col("_writer")), F.lit(False)
        )
        if guarded
        else F.lit(True)
    )
    write = has_new & (~has_old | allowed)
    changed = {
        "sequence_id": F.when(write, F.col("_sequence_id")).otherwise(F.col("sequence_id")),
        "closed": F.when(write, F.col("_closed")).otherwise(F.col("closed")),
        "owner": F.when(has_old, F.col("owner")).otherwise(F.col("_writer")),
    }
    joined = old.join(new, SHARD_KEYS, "full_outer")
    return joined.select(*[changed.get(n, F.col(n)).alias(n) for n in PROGRESS.fieldNames()])


def refused_checkpoints(progress: DataFrame, updates: DataFrame, writer: str) -> DataFrame:
    """Updates the guard turns away: a pending claim or another owner."""
    stored = progress.select(*SHARD_KEYS, "owner", "claim_request")
    return updates.join(stored, SHARD_KEYS).filter(
        F.col("claim_request").isNotNull()
        | F.col("owner").isNull()
        | (F.col("owner") != writer)
    )


def drained_shards(ended: DataFrame, records: DataFrame) -> DataFrame:
    """Ended shards with no record after their checkpoint, with ``drained``.

    ``ended`` has ``stream, shard_id, sequence_id``.  The log is first reduced to one tip
    per shard on the map side; joining it record by record would send a whole
    hot shard to one task.
    """
    tips = key_bounds(records, SHARD_KEYS).select(*SHARD_KEYS, F.col("last_key").alias("_tip"))
    at = seq_key(F.coalesce("sequence_id", F.lit("")))
    return (
        ended.join(tips, SHARD_KEYS, "left")
        .withColumn("drained", F.col("_tip").isNull() | (F.col("_tip") <= at))
        .drop("_tip")
    )


def closing_updates(updates: DataFrame, ended: DataFrame, records: DataFrame) -> DataFrame:
    """Add ``closed`` to updates: the shard has ended and is drained.

    Any other checkpoint writes ``closed = false`` again.  ``records`` must hold
    the ended shards whole; leaving the others out saves reading their folders.
    """
    ends = ended.select(*SHARD_KEYS, F.lit(True).alias("_ended"))
    marked = drained_shards(updates.join(ends, SHARD_KEYS, "left"), records)
    return marked.withColumn(
        "closed", F.coalesce(F.col("_ended") & F.col("drained"), F.lit(False))
    ).drop("_ended", "drained")
