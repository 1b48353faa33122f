"""The stored progress table: rows to begin with, and what is only added to them.

Three folders.  ``base`` holds the rows a table begins with.  ``owners`` holds who took a
shard over, and when.  ``updates`` holds checkpoints: each writer adds those of a micro-batch
as one folder, by its name and the batch's number, so writers never touch each other's files
and a replayed batch finds its own folder.  Reading folds the updates: an update counts if
its writer owned the shard, without a pending claim, when it was written.

So that this can go on for years, a writer now and then stores its own updates folded
(``fold_updates``); what they replace is not read any more and can be removed (``prune``).
A folder is visible when Spark has committed it; nothing is overwritten that a reader may hold.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.functions.measures import seconds
from shardbrook.functions.sequence import seq_key
from shardbrook.schema import PROGRESS, SHARD_KEYS
from shardbrook.storage import folders, read_if_present, remove

UPDATE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("writer", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)

OWNER = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("claim_request", T.StringType()),
        T.StructField("since", T.TimestampType()),
    ]
)

# Where a folder of updates lies: whose, and up to which number.
_PLACE = [T.StructField("who", T.StringType()), T.StructField("upto", T.LongType())]

# Updates this young are never folded: an owner's row may be about to become visible.
SETTLE_SECONDS = 3600


def empty_progress(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PROGRESS)


def write_base(progress: DataFrame, path: str) -> None:
    """Rows a table begins with: owners, claims and checkpoints set up elsewhere.

    They are written once; ``add_owners`` changes owners and claims afterwards.
    """
    rows = progress.select(*PROGRESS.fieldNames())
    rows.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/base")


def add_owners(owners: DataFrame, path: str) -> None:
    """Add who holds shards from now on (``stream, shard_id, owner``).

    ``claim_request`` says who asks for the shard (none if absent); while it is set nobody's
    checkpoints count.  ``since`` is now if absent.
    """
    given = set(owners.columns)
    claim = F.col("claim_request") if "claim_request" in given else F.lit(None)
    since = F.col("since") if "since" in given else F.current_timestamp()
    owners.select(
        *SHARD_KEYS, "owner", claim.cast("string").alias("claim_request"), since.alias("since")
    ).write.mode("append").parquet(f"{path.rstrip('/')}/owners")


def read_owners(spark: SparkSession, path: str) -> DataFrame:
    """Every change of owner or claim."""
    found = read_if_present(spark, f"{path.rstrip('/')}/owners", OWNER)
    return spark.createDataFrame([], OWNER) if found is None else found


def _who(writer: str | None) -> str:
    return "anyone" if writer is None else hashlib.md5(writer.encode()).hexdigest()


def _place(path: str, kind: str, writer: str | None) -> str:
    return f"{path.rstrip('/')}/{kind}/who={_who(writer)}"


def _numbers(spark: SparkSession, path: str, kind: str, writer: str | None) -> list[int]:
    """Numbers of a writer's folders, whether or not they are finished."""
    names = folders(spark, _place(path, kind, writer))
    return [int(n.removeprefix("upto=")) for n in names if n.startswith("upto=")]


def _folders(spark: SparkSession, path: str, kind: str) -> DataFrame:
    placed = T.StructType([*UPDATE.fields, *_PLACE])
    found = read_if_present(spark, f"{path.rstrip('/')}/{kind}", placed)
    return spark.createDataFrame([], placed) if found is None else found


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """All updates that still count: each writer's newest folded ones and those after them."""
    single = _folders(spark, path, "updates")
    if "folded" not in folders(spark, path):
        return single.select(*UPDATE.fieldNames())
    folded = _folders(spark, path, "folded")
    newest = folded.groupBy("who").agg(F.max("upto").alias("_folded"))
    return (
        folded.join(newest, "who").filter("upto = _folded").select(*UPDATE.fieldNames())
    ).unionByName(
        single.join(newest, "who", "left")
        .filter("_folded IS NULL OR upto > _folded")
        .select(*UPDATE.fieldNames())
    )


def _last_number(spark: SparkSession, path: str, kind: str, writer: str | None) -> int:
    own = _folders(spark, path, kind).filter(F.col("who") == _who(writer))
    last = own.agg(F.max("upto").alias("n")).first()["n"]
    return -1 if last is None else last


def next_number(spark: SparkSession, path: str, writer: str | None) -> int:
    """The number after a writer's last one."""
    kinds = [k for k in ("updates", "folded") if _numbers(spark, path, k, writer)]
    return 1 + max((_last_number(spark, path, kind, writer) for kind in kinds), default=-1)


def add_updates(
    updates: DataFrame,
    path: str,
    number: int,
    writer: str | None = None,
    fold_every: int | None = None,
) -> None:
    """Add checkpoints (``stream, shard_id, sequence_id``, perhaps ``closed``) once.

    Of several rows for a shard the furthest counts.  A number that is there already
    is a replay and is left as it is.  After every ``fold_every`` numbers the
    writer's updates are folded.
    """
    spark = updates.sparkSession
    # Folding begins after its last number was added, so a folder's name is enough here.
    if number <= max(_numbers(spark, path, "folded", writer), default=-1):
        return
    folder = f"{_place(path, 'updates', writer)}/upto={number}"
    there = read_if_present(spark, folder, UPDATE)
    if there is not None and not there.isEmpty():
        return
    closed = F.coalesce("closed", F.lit(False)) if "closed" in updates.columns else F.lit(False)
    named = updates.select(*SHARD_KEYS, "sequence_id", closed.alias("closed"))
    furthest = F.max_by(F.struct("sequence_id", "closed"), seq_key("sequence_id"))
    named.groupBy(*SHARD_KEYS).agg(furthest.alias("u")).select(
        *SHARD_KEYS,
        "u.*",
        F.lit(writer).cast("string").alias("writer"),
        F.lit(number).cast("bigint").alias("number"),
        F.current_timestamp().alias("written_at"),
    ).write.mode("overwrite").parquet(folder)
    if fold_every and (number + 1) % fold_every == 0:
        fold_updates(spark, path, writer)


def _first_owners(base: DataFrame, updates: DataFrame, owners: DataFrame) -> DataFrame:
    """Whose shards are that nobody was given before: the writer's of the first update."""
    first = F.min_by(F.struct("writer", "written_at"), F.struct("written_at", "number"))
    given = owners.groupBy(*SHARD_KEYS).agg(F.min("since").alias("_given"))
    return (
        updates.groupBy(*SHARD_KEYS)
        .agg(first.alias("_first"))
        .join(base, SHARD_KEYS, "left_anti")
        .join(given, SHARD_KEYS, "left")
        .filter(F.col("_given").isNull() | (F.col("_given") > F.col("_first.written_at")))
        .select(
            *SHARD_KEYS,
            F.col("_first.writer").alias("owner"),
            F.lit(None).cast("string").alias("claim_request"),
            F.col("_first.written_at").alias("since"),
        )
    )


def _ownership(base: DataFrame, updates: DataFrame, owners: DataFrame) -> DataFrame:
    """OWNER rows of every shard; the base's come before all others."""
    begun = base.select(
        *SHARD_KEYS, "owner", "claim_request", F.lit(None).cast("timestamp").alias("since")
    )
    return begun.unionByName(_first_owners(base, updates, owners)).unionByName(owners)


def _counted(updates: DataFrame, ownership: DataFrame) -> DataFrame:
    """The updates whose writer held the shard, unclaimed, when they were written.

    Updates and changes of owner meet in one row order per shard: each update takes
    the last change before it.  Updates without a writer always count.
    """
    changes = ownership.select(
        *SHARD_KEYS,
        F.col("since").alias("written_at"),
        F.struct("owner", "claim_request").alias("_change"),
        F.lit(0).alias("_update"),
    )
    so_far = (
        Window.partitionBy(*SHARD_KEYS)
        .orderBy(F.asc_nulls_first("written_at"), "_update")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    held = F.col("_held")
    return (
        changes.unionByName(updates.withColumn("_update", F.lit(1)), allowMissingColumns=True)
        .withColumn("_held", F.last("_change", ignorenulls=True).over(so_far))
        .filter("_update = 1")
        .filter(
            F.col("writer").isNull()
            | (held["claim_request"].isNull() & (F.col("writer") == held["owner"]))
        )
        .select(*UPDATE.fieldNames())
    )


def fold(base: DataFrame, updates: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """Progress after all updates.

    An update counts if its writer was the shard's owner when it was written and no claim on
    it was pending.  The owner is the base's until ``owners`` (OWNER rows) hand the shard over; a
    shard with no row belongs to the writer of its first update.  Updates without a
    writer are always taken.  A writer's numbers order its own updates; those of
    several writers go by time.
    """
    if owners is None:
        owners = updates.sparkSession.createDataFrame([], OWNER)
    ownership = _ownership(base, updates, owners)
    of_writer = F.max_by(F.struct("written_at", "sequence_id", "closed"), F.struct("number", "written_at"))
    newest = (
        _counted(updates, ownership)
        .groupBy(*SHARD_KEYS, "writer")
        .agg(of_writer.alias("_new"))
        .groupBy(*SHARD_KEYS)
        .agg(F.max_by("_new", F.col("_new.written_at")).alias("_new"))
    )
    # The base's row has no time, and is the last only where there is no other.
    current = ownership.groupBy(*SHARD_KEYS).agg(
        F.max_by(
            F.struct("owner", "claim_request"), F.coalesce("since", F.lit(0).cast("timestamp"))
        ).alias("_now")
    )
    new = F.col("_new").isNotNull()
    changed = {
        "owner": F.col("_now.owner"),
        "claim_request": F.col("_now.claim_request"),
        "sequence_id": F.when(new, F.col("_new.sequence_id")).otherwise(F.col("sequence_id")),
        "closed": F.when(new, F.col("_new.closed")).otherwise(F.col("closed")),
    }
    return (
        current.join(base, SHARD_KEYS, "left")
        .join(newest, SHARD_KEYS, "left")
        .select(*[changed.get(n, F.col(n)).alias(n) for n in PROGRESS.fieldNames()])
    )


def read_base(spark: SparkSession, path: str) -> DataFrame:
    base = read_if_present(spark, f"{path.rstrip('/')}/base", PROGRESS)
    return empty_progress(spark) if base is None else base


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; no rows before anything was written."""
    base = read_base(spark, path)
    if not {"updates", "folded", "owners"} & set(folders(spark, path)):
        return base
    return fold(base, read_updates(spark, path), read_owners(spark, path))


def fold_updates(
    spark: SparkSession, path: str, writer: str | None, settle_seconds: int = SETTLE_SECONDS
) -> None:
    """Store a writer's updates folded: its newest one of each shard that counts.

    Updates younger than ``settle_seconds`` are stored as they are, since a change of owner may
    be on its way.  Shards that the writer's first update made its own are entered in
    ``owners``, as that update may be left out from now on.  Reading begins at the newest
    folded rows; ``prune`` removes what came before.  Call it from the writer itself.
    """
    upto = _last_number(spark, path, "updates", writer)
    if upto <= _last_number(spark, path, "folded", writer):
        return
    base, updates, owners = read_base(spark, path), read_updates(spark, path), read_owners(spark, path)
    same = F.col("writer").eqNullSafe(F.lit(writer).cast("string"))
    if writer is not None:
        add_owners(_first_owners(base, updates, owners).filter(F.col("owner") == writer), path)
    old = F.col("written_at") < F.current_timestamp() - seconds(settle_seconds)
    counted = _counted(updates, _ownership(base, updates, owners)).filter(same & old)
    newest = counted.groupBy(*SHARD_KEYS).agg(
        F.max_by(F.struct(*UPDATE.fieldNames()), F.struct("number", "written_at")).alias("u")
    )
    rows = newest.select("u.*").unionByName(updates.filter(same & ~old))
    # What may be there already is the rest of a write that was cut short.
    folder = f"{_place(path, 'folded', writer)}/upto={upto}"
    rows.write.mode("overwrite").parquet(folder)


def prune(spark: SparkSession, path: str, writer: str | None) -> int:
    """Remove a writer's folders that its newest folded rows replace; how many there were.

    A reader that began before those rows were stored must have ended.
    """
    newest, removed = _last_number(spark, path, "folded", writer), 0
    for kind, past in (("updates", newest), ("folded", newest - 1)):
        for number in _numbers(spark, path, kind, writer):
            if number <= past:
                remove(spark, f"{_place(path, kind, writer)}/upto={number}")
                removed += 1
    return removed
