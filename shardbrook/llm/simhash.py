"""Near-duplicates by SimHash fingerprints and a binary trie self-join.

1. Every text gets a 64-bit fingerprint where it is read.  Equal fingerprints are
   one class; only distinct ones go on.
2. Two fingerprints with at most three differing bits agree in one of four blocks
   (in two of five, three of six: more blocks are taken as the number of distinct
   fingerprints grows).  For each choice of such blocks the bits are permuted so
   that the chosen blocks lead: a trie whose first levels have an error budget of
   zero.  Below them, pairs of trie nodes are traversed together, differing bits
   add up, and a pair is dropped as soon as they exceed the budget, or when all
   its members are known to hang together already.
3. A node with too many members is split into the pairs of its descendants (eight
   levels at a time) that are still within the budget, so no task grows with a
   dense spot.
4. Tasks give each member's link to the first of its class within the task; the
   links are closed over by passing on the smallest label.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.llm.common import map_rows
from shardbrook.storage import store

BITS = 64
BUDGET = 3


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42); 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = [end + i for i, end in enumerate(accumulate(map(len, words)))]
        starts = [0] + [end + 1 for end in ends[: len(ends) - shingle]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])]
    packed = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(packed, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """``id_col, fingerprint`` (the 64 bits as a signed long) for every row."""
    rows = docs.select(
        F.col(id_col),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def setup():
        return lambda columns: (
            ((key, fingerprint(text, shingle)), 16) for key, text in zip(*columns)
        )

    schema = T.StructType([rows.schema[0], T.StructField("fingerprint", T.LongType())])
    return map_rows(rows, setup, schema)


# --- trie traversal inside a task -------------------------------------------------


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the classes of linked members; ``label`` points at a class's first member."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            above = label[label]
            if np.array_equal(above, label):
                break
            label[:] = above


def trie_classes(
    values: np.ndarray,
    pairs: list[np.ndarray],
    budget: int,
    leaf_pairs: int = 64,
    order: np.ndarray | None = None,
) -> np.ndarray:
    """The class of each value under links of at most ``budget`` differing bits.

    ``order`` is sorted and equals ``values`` (by default it is the values) in the
    bits below each node's depth; a trie node is a range of it.  ``pairs`` are
    arrays ``low1, high1, low2, high2, differing, depth`` of node pairs to join.
    """
    order = values if order is None else order
    label = np.arange(len(values))
    stack = [pairs]
    while stack:
        node = stack.pop()
        if len(node[0]) > 1 << 16:  # the bound of what is open at one time
            half = len(node[0]) // 2
            stack.append([x[half:] for x in node])
            node = [x[:half] for x in node]
        low1, high1, low2, high2, differing, depth = node
        # Pairs whose members hang together already need no more work.
        steps = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        joined = (
            (steps[high1 - 1] == steps[low1])
            & (steps[high2 - 1] == steps[low2])
            & (label[low1] == label[low2])
        )
        low1, high1, low2, high2, differing, depth = (
            x[~joined] for x in (low1, high1, low2, high2, differing, depth)
        )
        if not len(low1):
            continue
        many = (high1 - low1) * (high2 - low2)
        small = (many <= leaf_pairs) | (depth >= BITS)
        if small.any():
            width, n = (high2 - low2)[small], many[small]
            owner = np.repeat(np.arange(len(n)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i = low1[small][owner] + place // width[owner]
            j = low2[small][owner] + place % width[owner]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            _unite(label, i[near], j[near])
        low1, high1, low2, high2, differing, depth = (
            x[~small] for x in (low1, high1, low2, high2, differing, depth)
        )
        if not len(low1):
            continue
        bit = np.uint64(1) << (np.uint64(BITS - 1) - depth.astype(np.uint64))

        def middle(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Where the children part: the first member with the bit set."""
            first = order[low]
            want = (first & ~(bit | (bit - np.uint64(1)))) | bit
            return np.clip(np.searchsorted(order, want), low, high)

        mid1, mid2, same = middle(low1, high1), middle(low2, high2), low1 == low2
        children = [
            (low1, mid1, low2, mid2, 0, None),
            (mid1, high1, mid2, high2, 0, None),
            (low1, mid1, mid2, high2, 1, None),
            (mid1, high1, low2, mid2, 1, ~same),  # the mirror image within one node
        ]
        grown = []
        for a, b, c, d, more, only in children:
            keep = (b > a) & (d > c) & (differing + more <= budget)
            keep &= ~((a == c) & (b - a == 1))
            if only is not None:
                keep &= only
            grown.append([x[keep] for x in (a, b, c, d, differing + more, depth + 1)])
        stack.append([np.concatenate(x) for x in zip(*grown)])
    return label


# --- distributed part ------------------------------------------------------------


def block_count(distinct: int, per_node: int = 256) -> int:
    """Blocks to cut fingerprints into, so that leading blocks leave few in a node."""
    blocks = BUDGET + 1
    while blocks < 8 and distinct > per_node << (BITS * (blocks - BUDGET) // blocks):
        blocks += 1
    return blocks


def _permuted(fingerprint: str, blocks: int) -> tuple[list[str], int]:
    """SQL of the permuted fingerprints, and how many bits lead (at least)."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    wordings, leading = [], BITS
    for chosen in combinations(range(blocks), blocks - BUDGET):
        order = [*chosen, *(i for i in range(blocks) if i not in chosen)]
        left, parts = BITS, []
        for i in order:
            left -= widths[i]
            mask = (1 << widths[i]) - 1
            parts.append(
                f"shiftleft(shiftrightunsigned({fingerprint}, {edges[i]}) & {mask}L, {left})"
            )
        wordings.append(" | ".join(parts))
        leading = min(leading, sum(widths[i] for i in chosen))
    return wordings, leading


def link_classes(
    distinct: DataFrame, *, blocks: int | None = None, node_rows: int = 50_000
) -> DataFrame:
    """Links ``a, b`` that join all fingerprints within the budget of each other.

    ``distinct`` has one column, ``fingerprint``, without repeats.  Links within a
    task go to the first member of its class there, so there are never more of
    them than members.
    """
    blocks = blocks or block_count(distinct.count())
    wordings, leading = _permuted("fingerprint", blocks)
    choices = ", ".join(
        f"named_struct('turn', {i}, 'x', {sql})" for i, sql in enumerate(wordings)
    )
    nodes = distinct.select("fingerprint", F.expr(f"inline(array({choices}))")).select(
        "fingerprint",
        "turn",
        "x",
        F.expr(f"shiftrightunsigned(x, {BITS - leading})").alias("u"),
        F.expr(f"shiftrightunsigned(x, {BITS - leading})").alias("v"),
        F.lit(0).alias("differing"),
        F.lit(leading).alias("depth"),
    )
    key = ["turn", "u", "v", "depth"]
    ready = None
    for depth in range(leading, BITS - 8, 8):
        crowded = store(
            nodes.groupBy(*key).count().where(F.col("count") > node_rows).drop("count"), "crowded"
        )
        if crowded.isEmpty():
            break
        nodes = store(nodes, "nodes")
        calm = nodes.join(crowded, key, "left_anti")
        ready = calm if ready is None else ready.unionByName(calm)
        rest = BITS - depth
        nodes = (
            nodes.join(crowded, key, "left_semi")
            .withColumn("own", F.expr(f"shiftrightunsigned(x, {rest - 8})"))
            .withColumn("other", F.expr(f"IF(shiftrightunsigned(x, {rest}) = u, v, u)"))
            .withColumn(
                "far",
                F.expr(
                    "explode(filter(sequence(0L, 255L), c -> "
                    f"differing + bit_count(c ^ (own & 255L)) <= {BUDGET}))"
                ),
            )
            .withColumn("child", F.expr("shiftleft(other, 8) | far"))
            .select(
                "fingerprint",
                "turn",
                "x",
                F.least("own", "child").alias("u"),
                F.greatest("own", "child").alias("v"),
                F.expr("CAST(differing + bit_count(far ^ (own & 255L)) AS INT)").alias("differing"),
                F.lit(depth + 8).alias("depth"),
            )
        )
    if ready is not None:
        nodes = ready.unionByName(nodes)
    dealt = nodes.repartition(*key).sortWithinPartitions(*key, "x")
    budget = BUDGET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, 10_000):
                part = pa.Table.from_batches([batch.slice(start, 10_000)])
                held = part if held is None else pa.concat_tables([held, part])
                if held.num_rows < 20_000:
                    continue
                last = _changes(*(held[c].to_numpy() for c in key))[-1]  # may go on
                if last:
                    yield _links_of(held.slice(0, last), budget)
                    held = held.slice(last)
        if held is not None and held.num_rows:
            yield _links_of(held, budget)

    return dealt.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _links_of(part: pa.Table, budget: int) -> pa.RecordBatch:
    """Links within the runs of rows that share a pair of trie nodes."""
    turn, u, v, depth = (part[c].to_numpy() for c in ("turn", "u", "v", "depth"))
    values = part["x"].to_numpy().view(np.uint64)
    rest = np.uint64(BITS) - depth.astype(np.uint64)
    low = _changes(turn, u, v, depth, values >> rest)  # trie nodes
    high = np.append(low[1:], len(values))
    # Sorted as a whole: the node's number in place of the bits its members share.
    number = np.repeat(np.arange(len(low), dtype=np.uint64), high - low)
    order = (values & ((np.uint64(1) << rest) - np.uint64(1))) | (number << np.uint64(48))
    follows = np.zeros(len(low), dtype=bool)  # a node and the one before it are a pair
    follows[1:] = ~np.isin(low[1:], _changes(turn, u, v, depth))
    alone = np.flatnonzero((u == v)[low] & (high - low > 1))
    second = np.flatnonzero(follows)
    one, two = np.concatenate((alone, second - 1)), np.concatenate((alone, second))
    differing = part["differing"].to_numpy()[low[one]].astype(np.int64)
    label = trie_classes(
        values,
        [low[one], high[one], low[two], high[two], differing, depth[low[one]].astype(np.int64)],
        budget,
        order=order,
    )
    fingerprints = part["fingerprint"].to_numpy()
    linked = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays(
        [pa.array(fingerprints[linked]), pa.array(fingerprints[label[linked]])], names=["a", "b"]
    )


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, label``: the smallest node that links ``a, b`` reach from each node.

    Every round each node takes the smallest label around it and then that label's
    own label, so the distance covered doubles; each round is written, so a lost
    executor costs no more than the round.
    """
    both = store(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = store(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.min("a")).alias("label")
        ),
        name,
    )
    while True:
        around = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        taken = labels.join(around, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = store(
            taken.join(above, "label").select(
                "node", "was", F.least("label", "above").alias("label")
            ),
            name,
        )
        moved = jumped.where("label <> was").limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    blocks: int | None = None,
    node_rows: int = 50_000,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row.

    A component holds all rows whose fingerprints hang together by links of at most
    three differing bits; its id is its smallest ``id_col``.  Texts without words
    (null, empty, white space) have fingerprint 0.  Rows with a null id are linked
    like any other but never name a component; a component of such rows only has a
    null id.  Repeated rows come back as often as they went in.  Other columns are
    not read.
    """
    found = store(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash")
    found = found.select(F.col(id_col).alias("_id"), F.col("fingerprint"))
    classes = store(found.groupBy("fingerprint").agg(F.min("_id").alias("first_id")), "classes")
    labels = components(
        link_classes(classes.select("fingerprint"), blocks=blocks, node_rows=node_rows)
    )
    rooted = classes.join(
        labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "first_id", F.coalesce("label", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = rooted.join(named, "root").select("fingerprint", "component_id")
    return found.join(members, "fingerprint").select(
        F.col("_id").alias(id_col), "fingerprint", "component_id"
    )
