"""Running totals along a shard, without putting a shard into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.functions.sequence import key_bounds, run_of, time_key
from shardbrook.schema import SHARD_KEYS
from shardbrook.storage import store


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    stretch: Column,
    name: str,
    starts: str | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` from the start of the key to this row.

    ``stretch`` cuts each key into consecutive pieces; it must not decrease along
    ``order``.  A plain window would sort all rows of a hot key in one task.
    Here only the stretch totals (one row each, summed before the shuffle) are
    windowed per key; each total enters its stretch as an opening row, and the
    rows themselves are windowed per key *and* stretch.  The data is shuffled
    once and never joined.  A row without an order value stands before all others.

    The result is spread by (keys, ``_stretch``) and sorted by ``order`` in each
    stretch; ``_stretch`` is kept so that callers can build on that.  ``starts`` names a column
    that is true in the first row of a stretch; it takes no further sort.
    """
    keys, order = list(keys), list(order)
    rows = df.withColumn("_stretch", stretch).withColumn("_value", value.cast("bigint"))
    totals = rows.groupBy(*keys, "_stretch").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    opening = totals.select(
        *keys,
        "_stretch",
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_value"),
        F.lit(True).alias("_opening"),
    )
    # The opening row comes first, then rows without an order value.
    in_order = Window.partitionBy(*keys, "_stretch").orderBy(
        F.asc_nulls_last("_opening"), *[F.asc_nulls_first(o) for o in order]
    )
    within = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {name: F.sum("_value").over(within)}
    if starts:
        added[starts] = F.lag("_opening").over(in_order).isNotNull()
    return (
        rows.unionByName(opening, allowMissingColumns=True)
        .withColumns(added)
        .filter("_opening IS NULL")
        .drop("_opening", "_value")
    )


def leases_held(lease_events: DataFrame, target_events: int = 1_000_000) -> DataFrame:
    """The leases-held gauge after every gain (+1) and loss (-1).

    Needs an ``event_id``, a whole number that orders events with equal time.  Stretches follow
    from the rows (``in_stretches``), so a burst of one worker's events is many tasks.
    """
    keys = [*SHARD_KEYS, "worker"]
    moves = lease_events.filter(F.col("kind").isin("gained", "lost")).withColumn(
        "_key", time_key("ts", "event_id")
    )
    return running_total(
        in_stretches(moves, target_events, keys, "_key"),
        keys=keys,
        order=["ts", "event_id"],
        value=lease_changes(),
        stretch=F.col("_stretch"),
        name="leases_held",
    ).drop("_stretch", "_key")


def lease_changes() -> Column:
    return (
        F.when(F.col("kind") == "gained", 1).when(F.col("kind") == "lost", -1).otherwise(0)
    )


def _same(by: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    """Equal in all columns; null equals null."""
    equal = [left[c].eqNullSafe(right[c]) for c in by]
    return reduce(Column.__and__, equal)


def in_stretches(
    records: DataFrame,
    target_records: int = 1_000_000,
    keys: Sequence[str] = SHARD_KEYS,
    key: str = "seq_key",
) -> DataFrame:
    """Add ``_stretch``: consecutive pieces of each shard of at most twice the target.

    A shard begins as one stretch.  Stretches with more records are cut: their span
    and count give the digits to drop where numbers lie evenly.  What is still too
    large (a burst) is cut again by its own density, then by so few digits that only repeated
    keys can make a stretch crowded, and at last key by key.  Records of one key, or of none,
    may stand in any order, so they are dealt out; only those are written, since a
    record must keep its place in the deal.

    Each round passes over the keys and joins a table with a row per crowded stretch;
    where no shard is crowded there is one pass and no join.
    """
    by = [*keys, "_stretch"]
    fine = len(str(max(1, target_records))) - 1
    # How many leading characters the first and the last key share.
    same = (
        "size(filter(sequence(1, octet_length(last_key)), "
        "i -> substring(first_key, 1, i) = substring(last_key, 1, i)))"
    )
    pieces = F.ceil(F.log10(F.col("n_records") / target_records)).cast("int")
    even = F.greatest(F.octet_length("last_key") - F.expr(same) - pieces, F.lit(0))
    dealt = records.withColumn("_stretch", F.lit(""))

    def crowded(*columns: Column) -> DataFrame:
        full = key_bounds(dealt, by, key).filter(F.col("n_records") > 2 * target_records)
        return store(full.select(*by, *columns), "crowded")

    one_key = (F.col("first_key") == F.col("last_key")) & (F.col("n_keyless") == 0)
    repeated = F.coalesce(one_key, F.lit(False)) | (F.col("n_keyless") == F.col("n_records"))
    for digits in (even, even, F.lit(fine), F.lit(0)):
        full = crowded(digits.alias("_digits"), repeated.alias("_repeated"), "n_records")
        if full.filter("NOT _repeated").isEmpty():
            break
        cut = full.filter("NOT _repeated").select(*by, "_digits")
        run = run_of(key, F.col("_digits"))
        joined = dealt.join(cut, _same(by, dealt, cut), "left").select(
            *[dealt[c] for c in dealt.columns if c != "_stretch"],
            dealt["_stretch"].alias("_was"),
            cut["_digits"].alias("_digits"),
        )
        stretch = F.when(F.col("_digits").isNotNull(), F.coalesce(run, F.col("_was")))
        dealt = joined.withColumn("_stretch", F.coalesce(stretch, F.col("_was"))).drop(
            "_was", "_digits"
        )
    else:
        full = crowded(repeated.alias("_repeated"), "n_records")
    if full.isEmpty():
        return dealt
    alike = full.filter("_repeated").select(
        *by, F.ceil(F.col("n_records") / target_records).alias("_parts")
    )
    place = F.pmod(F.monotonically_increasing_id(), F.col("_parts"))
    # A blank sorts before every digit.
    part = F.concat("_stretch", F.lit(" "), F.lpad(place.cast("string"), 12, "0"))
    hot = dealt.join(alike, _same(by, dealt, alike)).select(
        *[dealt[c] for c in dealt.columns], alike["_parts"]
    )
    hot = store(hot.withColumn("_stretch", part).drop("_parts"), "alike")
    return dealt.join(alike, _same(by, dealt, alike), "left_anti").unionByName(hot)


def shard_positions(
    records: DataFrame,
    digits: int | None = None,
    target_records: int = 1_000_000,
    starts: str | None = None,
) -> DataFrame:
    """Number the records of each shard from 1 in sequence order.

    Stretches follow from the rows (``in_stretches``); ``digits`` sets them by the
    number of last digits instead, where that is known to suit.
    """
    rows = in_stretches(records, target_records) if digits is None else records
    return running_total(
        rows,
        keys=SHARD_KEYS,
        order=["seq_key"],
        value=F.lit(1),
        stretch=F.col("_stretch") if digits is None else run_of("seq_key", digits),
        name="position",
        starts=starts,
    )
