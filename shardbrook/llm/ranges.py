"""Cut a table into key ranges of bounded size, by sampled splitters."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.storage import store

# Samples drawn for each range that is wanted.
OVERSAMPLE = 8

# Steps in which a draw can fall between 0 and 1.
_DRAWS = 1 << 52


def sort_key(lead: Column, *rest: Column) -> Column:
    """A key that sorts by its columns, null first.

    ``lead`` names a group; the second field is 0 in every row, so that a cut with 1
    there comes after the whole group.  Columns are integers or text.
    """
    fields = [c.alias(f"k{i}") for i, c in enumerate(rest)]
    return F.struct(lead.alias("lead"), F.lit(0).alias("after"), *fields)


def _place(key: Column, cuts: Column, n_cuts: int) -> Column:
    """How many of the sorted cuts are at or before ``key``, by binary search."""
    steps = [1 << i for i in reversed(range(n_cuts.bit_length()))]
    if not steps:
        return F.lit(0)

    def step(at: Column, width: Column) -> Column:
        there = F.get(cuts, at + width - 1)
        return F.when((at + width <= n_cuts) & (there <= key), at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _cuts_at(picked: DataFrame) -> DataFrame:
    """Cuts at the picked rows, or around their groups where ``_whole`` says so."""
    key = F.col("_key")
    names = picked.schema["_key"].dataType.names

    def edge(after: int) -> Column:
        inner = [
            F.lit(None).cast(picked.schema["_key"].dataType[n].dataType).alias(n)
            for n in names[2:]
        ]
        return F.struct(key["lead"].alias("lead"), F.lit(after).alias("after"), *inner)

    chosen = F.when(F.col("_whole"), F.array(edge(0), edge(1))).otherwise(F.array(key))
    return picked.select(F.explode(chosen).alias("_key"))


def in_ranges(rows: DataFrame, pieces: int) -> DataFrame:
    """``rows`` with ``_range``: consecutive ranges of ``_key``, none overfull.

    ``rows`` is a stored table with ``_key`` (``sort_key``, no two alike) and ``_size``
    (long, above 0).  A range holds at most about ``2 / pieces`` of all bytes and of
    all rows.  A row that is larger than that alone is a range by itself, with a
    negative number; ranges sort by ``abs(_range), _range``.

    Splitters are quantiles of a sample, drawn with odds that grow with a row's size.
    Ranges that turn out overfull are sampled again and cut, around whole groups of one
    ``lead`` while they hold several, and inside the group when it is alone.  There are
    some ``pieces`` of splitters whatever the table's size; they are a constant in
    the plan, and a row finds its range by binary search.  No row is shuffled here.
    """
    n, total = rows.agg(F.count("*"), F.sum("_size")).first()
    if not n:
        return rows.withColumn("_range", F.lit(0))
    most_rows, most_size = 2 * -(-n // pieces), 2 * -(-total // pieces)
    heavy = F.col("_size") > most_size
    cuts = [store(rows.where(heavy).select("_key"), "cuts")]
    kind = f"array<{rows.schema['_key'].dataType.simpleString()}>"
    seed = 0
    while True:
        every = cuts[0]
        for more in cuts[1:]:
            every = every.unionByName(more)
        keys = every.distinct().agg(F.to_json(F.sort_array(F.collect_list("_key"))), F.count("*"))
        listed, n_cuts = keys.first()
        place = _place(F.col("_key"), F.from_json(F.lit(listed), kind), n_cuts)
        ranged = rows.withColumn("_range", F.when(heavy, -place).otherwise(place))
        found = (
            ranged.where("_range >= 0")
            .groupBy("_range")
            .agg(
                F.count("*").alias("n"),
                F.sum("_size").alias("size"),
                F.min("_key.lead").eqNullSafe(F.max("_key.lead")).alias("alone"),
                F.count("_key.lead").alias("named"),
            )
            .where((F.col("n") > most_rows) | (F.col("size") > most_size))
            .collect()
        )
        if not found:
            return ranged
        seed += 1
        # Ranges to cut: into how many parts, and whether around whole groups.
        parts, whole = [0] * (n_cuts + 1), [False] * (n_cuts + 1)
        for r in found:
            parts[r["_range"]] = max(2, -(-2 * r["n"] // most_rows), -(-2 * r["size"] // most_size))
            whole[r["_range"]] = not (r["alone"] and r["named"] in (0, r["n"]))
        part = F.get(F.from_json(F.lit(json.dumps(parts)), "array<int>"), "_range")
        around = F.get(F.from_json(F.lit(json.dumps(whole)), "array<boolean>"), "_range")
        odds = OVERSAMPLE * pieces * (F.col("_size") / F.lit(total) + F.lit(1.0 / n)) / 2
        draw = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(_DRAWS)) / F.lit(float(_DRAWS))
        in_order = Window.partitionBy("_range").orderBy("_key")
        sample = (
            ranged.where((F.col("_range") >= 0) & (part > 0) & (draw < odds))
            .select("_key", "_range", part.alias("_parts"), around.alias("_whole"))
            .withColumn("_nth", F.row_number().over(in_order))
            .withColumn("_all", F.count("*").over(Window.partitionBy("_range")))
        )
        quantile = F.floor(F.col("_nth") * F.col("_parts") / F.col("_all"))
        before = F.floor((F.col("_nth") - 1) * F.col("_parts") / F.col("_all"))
        cuts.append(store(_cuts_at(sample.where(quantile > before)), "cuts"))
