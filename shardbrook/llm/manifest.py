"""A Merkle manifest of a dataset, with levels kept as strings of digests.

Nodes of a group in order are cut into aligned blocks.  A block keeps each of its levels
as one string of hex digests; fixed-width substrings of it are hashed to the next level,
and the substrings beside a node are its siblings.  The blocks' last digests are the
nodes of the next tier, until a group has one node; the groups' roots then are nodes too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardbrook.llm.ranges import in_ranges, sort_key
from shardbrook.storage import store

# Hex digits of a digest.
WIDTH = 64

# Ranges that nodes are put in order by: a task sorts some 2 / PIECES of them.
PIECES = 512

PATH = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row: each value with its byte count before it, '-' for null."""
    written = []
    for field in fields:
        text = field.cast("string")
        size = F.octet_length(text).cast("string")
        written.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*written))


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its way lead to."""
    return F.aggregate(
        path, node, lambda under, step: digest(F.concat(step["before"], under, step["after"]))
    )


def siblings(path: Column) -> Column:
    """The digests of a path from the leaf up, left to right, as one string."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _numbered(nodes: DataFrame, group: str, order: tuple[str, ...]) -> DataFrame:
    """``nodes`` with ``_position`` (from 0) in their group, and ``_count`` of it.

    Nodes are sorted in ranges of bounded size (``ranges``), so that a group with most of
    the rows is many tasks.  ``nodes`` is a stored table; equal nodes get a place each.
    """
    kept = nodes.columns
    keyed = store(
        nodes.select(
            "*",
            sort_key(
                F.col(group), *[F.col(c) for c in order], F.monotonically_increasing_id()
            ).alias("_key"),
            F.lit(1).cast("long").alias("_size"),
        ),
        "nodes",
    )
    ranged = in_ranges(keyed, PIECES)
    by = [group, "_range"]
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = ranged.groupBy(*by).agg(F.count("*").alias("_n")).select(
        *by,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(group)).alias("_count"),
    )
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("_key"))
    return ranged.withColumn("_nth", nth).join(parts, by).select(
        *kept, (F.col("_before") + F.col("_nth") - 1).alias("_position"), "_count"
    )


def _levels(first: Column, steps: Column, arity: int) -> Column:
    """The levels of a block, ``first`` and ``steps`` more, each a string of digests."""

    def above(level: Column) -> Column:
        runs = F.ceil(F.length(level) / (WIDTH * arity)).cast("int")
        hashed = F.transform(
            F.sequence(F.lit(0), runs - 1),
            lambda i: digest(F.substr(level, i * (WIDTH * arity) + 1, F.lit(WIDTH * arity))),
        )
        return F.array_join(hashed, "")

    turns = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        turns,
        F.array(first),
        lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))),
    )


def _segments(place: Column, levels: Column, steps: Column, arity: int) -> Column:
    """What stands beside a node's way through its block, in its run before and after it."""

    def beside(height: Column) -> Column:
        level = F.get(levels, height)
        at = F.floor(place / F.pow(F.lit(float(arity)), height)).cast("int")
        run = at - at % arity
        return F.struct(
            F.substr(level, run * WIDTH + 1, (at - run) * WIDTH).alias("before"),
            F.substr(level, (at + 1) * WIDTH + 1, (run + arity - 1 - at) * WIDTH).alias("after"),
        )

    heights = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(heights, beside)


def _blocks(numbered: DataFrame, group: str, kept: list[str], arity: int, height: int) -> DataFrame:
    """A tier: ``group, _block``, its ``_nodes`` and ``_levels``, and the ``_tops`` of its group."""
    size = arity**height
    steps = F.lit(0)
    for h in range(height):
        steps = steps + (F.col("_count") > arity**h).cast("int")
    member = F.struct(
        "_position", F.col("_node").alias("node"), F.struct(F.lit(0), *kept).alias("kept")
    )
    gathered = (
        numbered.withColumn("_block", F.floor(F.col("_position") / size))
        .groupBy(group, "_block")
        .agg(
            F.array_sort(F.collect_list(member)).alias("_nodes"),
            F.first(steps).alias("_steps"),
            F.first(F.ceil(F.col("_count") / size)).alias("_tops"),
        )
    )
    first = F.array_join(F.transform("_nodes", lambda m: m["node"]), "")
    return gathered.withColumn("_levels", _levels(first, F.col("_steps"), arity))


def _with_paths(blocks: DataFrame, group: str, above: DataFrame | None, arity: int) -> DataFrame:
    """The nodes of stored blocks with ``path`` as far as ``above`` knows it."""
    further = F.col("_further") if above is not None else F.array().cast(PATH)
    rows = blocks
    if above is not None:
        rows = blocks.join(
            above.select(group, F.col("_at").alias("_block"), F.col("path").alias("_further")),
            [group, "_block"],
        )
    nodes = F.transform(
        "_nodes",
        lambda m, i: F.struct(
            m["kept"].alias("kept"),
            m["_position"].alias("_at"),
            m["node"].alias("_node"),
            F.concat(
                _segments(i, F.col("_levels"), F.col("_steps"), arity).cast(PATH), further
            ).alias("path"),
        ),
    )
    return rows.select(group, F.inline(nodes))


def _trees(
    nodes: DataFrame, group: str, kept: list[str], order: tuple[str, ...], arity: int, height: int
) -> tuple[DataFrame, DataFrame]:
    """Trees over the groups of ``nodes``: all nodes with ``path``, and ``group, _top`` of each."""
    numbered = _numbered(nodes, group, order)
    tiers = []
    while True:
        blocks = store(
            _blocks(numbered, group, [] if tiers else kept, arity, height), "blocks"
        )
        tiers.append(blocks)
        tops = blocks.select(
            group,
            F.col("_block").alias("_position"),
            F.element_at("_levels", -1).alias("_node"),
            F.col("_tops").alias("_count"),
        )
        if tops.where("_count > 1").isEmpty():
            break
        numbered = tops
    above = None
    for blocks in reversed(tiers):
        above = _with_paths(blocks, group, above, arity)
    return above, tops.select(group, F.col("_node").alias("_top"))


def manifest(
    docs: DataFrame,
    *,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    keep: tuple[str, ...] = (),
    arity: int = 2,
    height: int = 8,
) -> DataFrame:
    """Every row with its ``leaf``, ``path``, ``subroot`` (of its group) and ``root``.

    Returns ``id_col``, the ``keep`` columns and those four.  A leaf is the digest of
    ``fields``.  Leaves of a group ascend by id; every ``arity`` consecutive nodes become
    one (the last run may have fewer) while there is more than one node.  Roots of groups,
    by name, become the root in the same way.  ``path`` holds, from the leaf up to the root, the
    digests beside the way: ``folded(leaf, path)`` is the root.

    Null ids come first and null names name a group, which is the first.  Rows alike in id are ordered
    by their leaves, so equal rows have equal subroots whatever their order.  An empty table gives no
    rows.  Names are compared by their UTF-8 bytes.

    A block has ``arity ** height`` nodes.  Only narrow tables are shuffled and stored: ids, digests,
    ``keep``, and strings of digests.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    kept = ["_row_kept"]
    leaves = docs.select(
        name.alias("_group"),
        F.struct(id_col, *keep).alias("_row_kept"),
        F.col(id_col).alias("_id"),
        leaf(*[F.col(c) for c in fields]).alias("_node"),
    )
    rows, tops = _trees(leaves, "_group", kept, ("_id", "_node"), arity, height)
    tops = store(tops.withColumn("_all", F.lit("")), "subroots")
    subroots = tops.select("_all", F.col("_group").alias("_id"), F.col("_top").alias("_node"))
    inner, root = _trees(subroots, "_all", ["_id"], ("_id",), arity, height)
    roots = inner.join(root, "_all").select(
        F.col("kept._id").alias("_group"),
        F.col("_node").alias("subroot"),
        F.col("path").alias("_rest"),
        F.col("_top").alias("root"),
    )
    return rows.join(store(roots, "roots"), "_group").select(
        "kept._row_kept.*",
        F.col("_node").alias("leaf"),
        F.concat("path", "_rest").alias("path"),
        "subroot",
        "root",
    )
