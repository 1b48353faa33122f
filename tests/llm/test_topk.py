import math
import random

import pytest

from shardbrook.llm import topk
from shardbrook.llm.oracles import LLM_ORACLES
from shardbrook.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, k=5, every=50):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, qv in usable:
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def _found(spark, rows, every=50, **how):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    vectors = topk.whole_vectors(table.selectExpr("*", "1 AS score", "'x' AS v"))
    found = topk.top_products(vectors, vectors.where(f"id % {every} = 0"), **how)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kind", ["unit", "lengths", "ties", "narrow"])
def test_against_brute_force(spark, kind):
    rng = random.Random(kind)
    rows = []
    for i in range(300):
        v = [rng.gauss(0, 1) for _ in range(8)]
        norm = math.sqrt(sum(x * x for x in v))
        size = {"unit": 1, "lengths": rng.lognormvariate(0, 1.5), "ties": 1, "narrow": 1}[kind]
        v = [x / norm * size for x in v]
        if kind == "ties":
            v = [rng.choice((0.0, 0.5)) for _ in range(8)]
        if kind == "narrow":  # close to one another, so cosine thresholds are high
            v = [1 + 0.05 * x for x in v[:1]] + [0.3 * x for x in v[1:]]
        rows.append((i, v))
    assert _found(spark, rows, 10, bucket_rows=40, query_block=7) == _brute(rows, every=10)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5]), (1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 1.0, 1.0]), (7, [0.25, -0.5]),
        (8, [0.25, -0.5]), (50, [-1.0, -1.0]), (100, [0.0, 0.0]), (9, [0.001, -0.001]),
        (150, [2.0, 2.0, 2.0]), (200, None),
    ]
    assert _found(spark, rows) == _brute(rows)
    assert _found(spark, []) == []
    assert _found(spark, [(50, [1.0])]) == []


def test_dimensions_sixty_four_apart(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([2, 66, 130]))]) for i in range(240)]
    assert _found(spark, rows, 10, bucket_rows=30, query_block=7) == _brute(rows, every=10)


def test_repeated_rows(spark):
    """A query counts once and does not meet rows of its own id; others rank side by side."""
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.1, 0.1])]
    assert [(q, r, i) for q, r, i, _ in _found(spark, rows)] == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, duck, sf):
    path = f"/root/testdata/sf{sf}"
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    wanted = sorted(duck.execute(LLM_ORACLES["op8_top_products"]).fetchall())
    found = LLM_QUERIES["op8_top_products"](spark, path).select("query_id", "rank", "vec_id", "score")
    assert sorted(tuple(r) for r in found.collect()) == wanted
