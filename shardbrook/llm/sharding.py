"""Shards of nearly equal size, by sampled splitters.

Rows are sorted into key ranges, each a small part of a shard; splitters come from a
size-weighted sample, and overfull ranges are cut again (``ranges``).  The ranges are
dealt to the shards by size, the largest first, always to the emptiest shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.llm.common import whole_text
from shardbrook.llm.ranges import in_ranges, sort_key
from shardbrook.storage import store

# Ranges for each shard.
PIECES = 64

# What the shards have in common: their sizes in bytes.
LAW = "bytes"


def text_size(column: str = "text") -> Column:
    """UTF-8 bytes of a text, null as none, plus one."""
    return F.octet_length(whole_text(column)).cast("long") + 1


def _dealt(ranges: DataFrame, shards: int) -> DataFrame:
    """``_range, n, shard`` for a table ``_range, n, size`` of bounded length."""
    listed = ranges.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("size")).alias("less"), "_range", "n"))
        ).alias("all")
    )

    def deal(state: Column, part: Column) -> Column:
        emptiest = F.array_position(state["loads"], F.array_min(state["loads"])) - 1
        loads = F.transform(
            state["loads"], lambda load, i: F.when(i == emptiest, load - part["less"]).otherwise(load)
        )
        return F.struct(
            loads.alias("loads"),
            F.concat(state["taken"], F.array(emptiest.cast("int"))).alias("taken"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<int>").alias("taken"),
    )
    taken = F.aggregate("all", start, deal)["taken"]
    # Zipped, so that the dealing is done once and not for each range.
    pairs = listed.select(F.inline(F.arrays_zip(F.col("all"), taken.alias("shard"))).alias("r", "shard"))
    return pairs.select("r._range", "r.n", "shard")


def shard_rows(
    rows: DataFrame,
    *,
    lead: Column,
    order_by: tuple[str, ...] = (),
    size: Column,
    shards: int = 8,
    pieces: int = PIECES,
) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0), ``slot`` (long, gapless in a shard) and ``size``.

    Rows of one ``lead`` are a group.  It stays in one shard, unless it is larger than
    a range may be, about ``2 / pieces`` of a shard in bytes or rows; then it is cut like any
    range, by ``order_by`` and at last row by row.  Shards differ by less than the
    largest range or the largest row.  Slots follow ``lead`` and ``order_by`` inside a
    range.

    ``size`` must be above 0.  Null keys are keys like any other, and repeated rows are
    rows of their own; an empty table gives no rows.  Existing columns of the three names are
    replaced.  The rows are written once to the shared folder (a row needs a number that
    stays); pass only the columns that are needed.  At most
    about ``4 * shards * pieces`` ranges are brought together to be dealt, whatever the input.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot", "size")]
    order = [F.col(c) for c in order_by]
    boxed = store(
        rows.select(
            F.struct(*kept).alias("_kept"),
            sort_key(lead, *order, F.monotonically_increasing_id()).alias("_key"),
            size.cast("long").alias("_size"),
        ),
        "sharding",
    )
    ranged = in_ranges(boxed, shards * pieces)
    dealt = store(
        _dealt(
            ranged.groupBy("_range").agg(F.count("*").alias("n"), F.sum("_size").alias("size")),
            shards,
        ),
        "ranges",
    )
    earlier = Window.partitionBy("shard").orderBy(F.abs("_range"), "_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    places = dealt.select(
        "_range", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    # Some thousand rows at most: the ranges.
    return (
        ranged.join(F.broadcast(places), "_range")
        .withColumn("slot", (F.col("_before") + nth - 1).cast("long"))
        .select("_kept.*", F.col("shard").cast("int").alias("shard"), "slot", F.col("_size").alias("size"))
    )


def shard_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    shards: int = 8,
    pieces: int = PIECES,
) -> DataFrame:
    """Documents in shards of nearly equal bytes; equal texts are a group.

    Returns ``id_col``, the ``keep`` columns and ``shard, slot, size``.  Keys are hashes of the
    texts, so a shard is a mixture of the whole corpus.  A null text is an empty one of size 1.
    """
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.struct(id_col, *keep).alias("_row_kept"),
        F.xxhash64(whole_text(text_col)).alias("_lead"),
        text_size(text_col).alias("_bytes"),
    )
    found = shard_rows(
        sized,
        lead=F.col("_lead"),
        order_by=("_id",),
        size=F.col("_bytes"),
        shards=shards,
        pieces=pieces,
    )
    return found.select("_row_kept.*", "shard", "slot", "size")


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Writes a folder for each shard, its files in slot order, none above ``rows_per_file``."""
    part = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.withColumn("_part", part)
        .repartition("shard", "_part")
        .sortWithinPartitions("shard", "slot")
        .drop("_part")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )
