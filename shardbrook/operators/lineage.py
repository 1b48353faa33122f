"""How shards follow from one another by splits and merges, and which may be read.

A shard list has a row per shard and parent (``stream, shard_id, parent_shard_id``): none or
null for a first shard, one for a child of a split, several for a merge.  A parent
that is not in the list is gone and counts as none.

Ancestors are found by pointer jumping: a table of all walks of length 1 is joined with
itself to walks of length 2, 4, 8 and so on, so a long history costs few rounds.  Every
round is written, and holds a row per shard and ancestor at that one distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store


def _walks(shards: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Walks ``stream, shard_id, ancestor`` of length 1, 2, 4, ..., and shards behind a cycle."""
    known = shards.select("stream", F.col("shard_id").alias("ancestor")).distinct()
    steps = store(
        shards.select(*SHARD_KEYS, F.col("parent_shard_id").alias("ancestor"))
        .join(known, ["stream", "ancestor"], "left_semi")
        .select(*SHARD_KEYS, "ancestor")
        .distinct(),
        "walks",
    )
    n_shards, walks = known.count(), []
    while not steps.isEmpty():
        walks.append(steps)
        # A walk longer than there are shards has been somewhere twice.
        if 2 ** (len(walks) - 1) >= n_shards:
            return walks, steps.select(*SHARD_KEYS).distinct()
        further = steps.select(
            "stream", F.col("shard_id").alias("ancestor"), F.col("ancestor").alias("_further")
        )
        steps = store(
            steps.join(further, ["stream", "ancestor"])
            .select(*SHARD_KEYS, F.col("_further").alias("ancestor"))
            .distinct(),
            "walks",
        )
    return walks, known.select("stream", F.col("ancestor").alias("shard_id")).limit(0)


def shard_generations(shards: DataFrame) -> DataFrame:
    """``generation``: the longest way back to a first shard, and the ``root_shard_id`` there.

    First shards are generation 0 and their own root; of several roots equally far the
    smallest is named.  Shards in a cycle, or behind one, have neither.
    """
    walks, cyclic = _walks(shards)
    every = shards.select(*SHARD_KEYS).distinct()
    at = every.join(cyclic, SHARD_KEYS, "left_anti").select(
        *SHARD_KEYS, F.col("shard_id").alias("ancestor"), F.lit(0).alias("generation")
    )
    # The longest walk, from the largest power of two down.
    for power in reversed(range(len(walks))):
        step = walks[power].select(
            "stream", F.col("shard_id").alias("ancestor"), F.col("ancestor").alias("_further")
        )
        moved = store(
            at.join(step, ["stream", "ancestor"])
            .select(
                *SHARD_KEYS,
                F.col("_further").alias("ancestor"),
                (F.col("generation") + 2**power).alias("generation"),
            )
            .distinct(),
            "generations",
        )
        at = at.join(moved, SHARD_KEYS, "left_anti").unionByName(moved)
    found = at.groupBy(*SHARD_KEYS).agg(
        F.max("generation").alias("generation"), F.min("ancestor").alias("root_shard_id")
    )
    return every.join(found, SHARD_KEYS, "left")


def readable_shards(shards: DataFrame, drained: DataFrame) -> DataFrame:
    """Every shard with ``drained``, and ``readable``: all its ancestors are drained.

    ``drained`` has ``stream, shard_id, drained``; shards without a row are not.  In a cycle a
    shard is its own ancestor.
    """
    walks, _ = _walks(shards)
    done = drained.filter("drained").select(*SHARD_KEYS).distinct()
    every = shards.select(*SHARD_KEYS).distinct()
    full = every.join(done, SHARD_KEYS, "left_anti").select(
        "stream", F.col("shard_id").alias("ancestor")
    )
    if walks:
        blocked = store(
            walks[0].join(full, ["stream", "ancestor"], "left_semi").select(*SHARD_KEYS).distinct(),
            "blocked",
        )
        # Blocked within twice as many steps: within half of them, or half-way and then so.
        for walk in walks:
            behind = blocked.select("stream", F.col("shard_id").alias("ancestor"))
            reached = walk.join(behind, ["stream", "ancestor"], "left_semi").select(*SHARD_KEYS)
            blocked = store(blocked.union(reached).distinct(), "blocked")
    else:
        blocked = every.limit(0)
    return (
        every.join(done.withColumn("drained", F.lit(True)), SHARD_KEYS, "left")
        .join(blocked.withColumn("_blocked", F.lit(True)), SHARD_KEYS, "left")
        .select(
            *SHARD_KEYS,
            F.coalesce("drained", F.lit(False)).alias("drained"),
            F.col("_blocked").isNull().alias("readable"),
        )
    )
