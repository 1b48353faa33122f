"""Who owns which shards, and how evenly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.operators.running import running_total
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store


def _invalid() -> Column:
    return F.col("owner").isNull() | F.col("shard_id").isNull()


def open_rows(progress: DataFrame) -> DataFrame:
    """Progress of shards that are not closed."""
    return progress.filter(~F.coalesce("closed", F.lit(False)))


def invalid_progress(progress: DataFrame) -> DataFrame:
    """How many rows lack an owner or a shard id."""
    return open_rows(progress).agg(
        F.count_if(_invalid()).alias("n_invalid"), F.count("*").alias("n_rows")
    )


def valid_rows(progress: DataFrame, strict: bool = False) -> DataFrame:
    """Open rows with owner and shard id; ``strict`` fails on any other."""
    rows = open_rows(progress)
    if not strict:
        return rows.filter(~_invalid())
    refuse = F.raise_error(F.lit("progress row without owner or shard id")).cast("boolean")
    return rows.filter(F.when(_invalid(), refuse).otherwise(F.lit(True)))


def owner_loads(
    progress: DataFrame, weights: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """Load of each owner: its number of shards, and their weight.

    ``weights`` (``stream, shard_id, weight``) can hold records or bytes per shard;
    without it a shard weighs 1.
    """
    rows = valid_rows(progress, strict).select("owner", *SHARD_KEYS)
    if weights is None:
        weighed = rows.withColumn("weight", F.lit(1).cast("bigint"))
    else:
        weighed = rows.join(weights.select(*SHARD_KEYS, "weight"), SHARD_KEYS, "left").withColumn(
            "weight", F.coalesce("weight", F.lit(0))
        )
    return weighed.groupBy("owner").agg(
        F.count("*").alias("n_shards"), F.sum("weight").alias("load")
    )


def active_owners(progress: DataFrame, strict: bool = False) -> DataFrame:
    """The shards of each owner, one row per shard, with the owner's total."""
    rows = valid_rows(progress, strict).select("owner", *SHARD_KEYS)
    return rows.join(rows.groupBy("owner").agg(F.count("*").alias("n_shards")), "owner")


def _in_owner(rows: DataFrame, name: str) -> DataFrame:
    """Number the shards of each owner from 1, in the order of a digest of their names.

    The digest cuts an owner's shards into even stretches, however many there are.
    """
    digest = F.md5(F.concat_ws("/", *SHARD_KEYS).cast("binary"))
    return running_total(
        rows.withColumn("_digest", digest),
        keys=["owner"],
        order=["_digest", "shard_id"],
        value=F.lit(1),
        stretch=F.substring("_digest", 1, 2),
        name=name,
    ).drop("_digest", "_stretch")


def owner_shard_lists(
    progress: DataFrame, page_size: int = 1000, strict: bool = False
) -> DataFrame:
    """The shards of each owner as lists of ``page_size``; the last one may be shorter.

    All pages of an owner together are its whole list; each is sorted.  Which shards
    share a page follows from a digest of their names, so that one owner with
    most of the shards is neither one task nor one huge array.
    """
    owned = valid_rows(progress, strict).select("owner", *SHARD_KEYS)
    page = F.floor((F.col("_nth") - 1) / F.lit(page_size)).cast("bigint")
    return (
        _in_owner(owned, "_nth")
        .groupBy("owner", page.alias("page"))
        .agg(
            F.sort_array(F.collect_list("shard_id")).alias("shards"),
            F.count("*").alias("n_shards"),
        )
    )


def owner_skew(
    progress: DataFrame, weights: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """Each owner's load against the even share, rounded down."""
    loads = owner_loads(progress, weights, strict)
    optimal = loads.agg(
        F.floor(F.sum("load") / F.count("*")).cast("bigint").alias("optimal")
    ).scalar()
    return loads.withColumn("optimal", optimal).withColumn(
        "over", F.col("load") > F.col("optimal")
    )


def heaviest_owner(
    progress: DataFrame, weights: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """The owner with most load, the first by name on a tie."""
    loads = owner_loads(progress, weights, strict)
    return loads.orderBy(F.desc("load"), "owner").limit(1)


def rebalance_plan(
    progress: DataFrame, owners: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """The fewest moves after which every owner has an even share: ``owner`` to ``new_owner``.

    An even share is the number of shards by the number of owners, rounded down; what is
    left over goes, one each, to the owners with most shards (by name on a tie), as that
    saves moves.  ``owners`` (``owner``) adds owners that hold nothing yet.

    Which shards an owner gives up follows from a digest of their names.  Shards given up
    and places left free are numbered by running sums in the order of owners' names and
    meet by number: a row each for a move, none for a pair of owners.  Owners, a row each,
    are ranked in one window; their shards are not.
    """
    rows = valid_rows(progress, strict).select("owner", *SHARD_KEYS)
    loads = rows.groupBy("owner").agg(F.count("*").alias("n_shards"))
    if owners is not None:
        loads = (
            owners.filter("owner IS NOT NULL").select("owner")
            .union(loads.select("owner"))
            .distinct()
            .join(loads, "owner", "left")
            .withColumn("n_shards", F.coalesce("n_shards", F.lit(0)))
        )
    loads = store(loads, "loads")
    n_shards, n_owners = loads.agg(F.sum("n_shards"), F.count("*")).first()
    share, left_over = divmod(n_shards or 0, n_owners or 1)
    nth = F.row_number().over(Window.orderBy(F.desc("n_shards"), "owner"))
    target = F.lit(share) + (nth <= left_over).cast("bigint")
    by_name = Window.orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)

    def before(number: Column) -> Column:
        return F.coalesce(F.sum(number).over(by_name), F.lit(0))

    change = F.col("n_shards") - F.col("target")
    ranked = loads.withColumn("target", target).select(
        "owner",
        F.greatest(change, F.lit(0)).alias("_gives"),
        F.greatest(-change, F.lit(0)).alias("_takes"),
    )
    ranked = store(
        ranked.withColumn("_given", before(F.col("_gives"))).withColumn(
            "_taken", before(F.col("_takes"))
        ),
        "shares",
    )
    giving = rows.join(ranked.filter("_gives > 0").select("owner", "_gives", "_given"), "owner")
    given = _in_owner(giving, "_nth").filter("_nth <= _gives")
    places = ranked.filter("_takes > 0").select(
        F.col("owner").alias("new_owner"),
        F.explode(F.sequence(F.col("_taken") + 1, F.col("_taken") + F.col("_takes"))).alias("_place"),
    )
    return (
        given.withColumn("_place", F.col("_given") + F.col("_nth"))
        .join(places, "_place")
        .select(*SHARD_KEYS, "owner", "new_owner")
    )
