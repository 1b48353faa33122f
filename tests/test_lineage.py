"""Reshard history: generations and reading order."""

import random

import pytest
from conftest import rows

from shardbrook.operators.lineage import readable_shards, shard_generations

SHARDS = "stream string, shard_id string, parent_shard_id string"


def _table(spark, edges):
    return spark.createDataFrame([("s", child, parent) for child, parent in edges], SHARDS)


def _drained(spark, names):
    schema = "stream string, shard_id string, drained boolean"
    return spark.createDataFrame([("s", n, True) for n in names] + [("s", "?", False)], schema)


HISTORY = [
    ("a", None), ("b", None),  # first shards
    ("a1", "a"), ("a2", "a"),  # a split
    ("m", "a2"), ("m", "b"),  # a merge of two generations
    ("m1", "m"), ("m2", "m"),
    ("orphan", "gone"), ("o1", "orphan"),  # a parent that is not listed
]


def test_generations_of_splits_merges_and_missing_parents(spark):
    found = rows(shard_generations(_table(spark, HISTORY)), "shard_id", "generation", "root_shard_id")
    assert found == [
        ("a", 0, "a"), ("a1", 1, "a"), ("a2", 1, "a"), ("b", 0, "b"), ("m", 2, "a"),
        ("m1", 3, "a"), ("m2", 3, "a"), ("o1", 1, "orphan"), ("orphan", 0, "orphan"),
    ]


def test_children_wait_for_all_their_ancestors(spark):
    shards = _table(spark, HISTORY)

    def readable(*drained):
        found = readable_shards(shards, _drained(spark, drained))
        return {r.shard_id for r in found.filter("readable").collect()}

    first = {"a", "b", "orphan"}
    assert readable() == first
    assert readable("a") == first | {"a1", "a2"}
    assert readable("a", "a2", "m") == first | {"a1", "a2"}  # b holds m and its children
    assert readable("a", "a2", "b") == first | {"a1", "a2", "m"}
    assert readable("a", "a2", "b", "m") == first | {"a1", "a2", "m", "m1", "m2"}
    assert readable("a2", "b", "m", "orphan") == first | {"o1"}


def test_cycles_have_no_generation_and_are_not_readable(spark):
    shards = _table(spark, [("x", "y"), ("y", "z"), ("z", "x"), ("behind", "x"), ("self", "self"), ("ok", None)])
    found = {r.shard_id: (r.generation, r.root_shard_id) for r in shard_generations(shards).collect()}
    assert found.pop("ok") == (0, "ok")
    assert set(found) == {"x", "y", "z", "behind", "self"} and set(found.values()) == {(None, None)}
    found = readable_shards(shards, _drained(spark, ["x", "y"]))
    assert rows(found.filter("readable"), "shard_id") == [("ok",)]


def test_no_shards(spark):
    assert shard_generations(_table(spark, [])).count() == 0
    assert readable_shards(_table(spark, []), _drained(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:03d}" for i in range(80)]
    parents = {n: rng.sample(names[max(0, i - 5) : i], min(i, rng.randint(0, 2))) for i, n in enumerate(names)}
    edges = [(n, p) for n in names for p in (parents[n] or [None])]
    drained = set(rng.sample(names, 60))
    depth, above = {}, {}
    for n in names:
        depth[n] = 1 + max((depth[p] for p in parents[n]), default=-1)
        above[n] = set(parents[n]).union(*(above[p] for p in parents[n]))
    shards = _table(spark, edges)
    assert rows(shard_generations(shards), "shard_id", "generation") == [(n, depth[n]) for n in names]
    found = readable_shards(shards, _drained(spark, drained))
    assert rows(found, "shard_id", "readable") == [(n, above[n] <= drained) for n in names]


def test_a_long_chain_takes_few_rounds(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    found = {r.shard_id: r.generation for r in shard_generations(_table(spark, chain)).collect()}
    assert found == {f"c{i}": i for i in range(300)}
