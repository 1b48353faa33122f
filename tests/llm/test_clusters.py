import hashlib
import math
import random

import pytest

from shardbrook.llm import clusters
from shardbrook.llm.oracles import CENTROIDS
from shardbrook.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _brute(vectors, k=16, rounds=3):
    """Centroids by id and vector, plainly."""
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors]

    def place(row):
        i, v = row
        return (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), v)

    centroids = [v for _, v in sorted(whole, key=place)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        taken = [near(v)[1] for _, v in whole]
        for n in range(len(centroids)):
            own = [v for (_, v), t in zip(whole, taken) if t == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in whole), key=str), centroids


def _odd(seed):
    rng = random.Random(seed)
    near = [[rng.choice([-0.5, 0.0, 0.25]) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + rng.choice([0, 0, 1 / 64]) for x in rng.choice(near)]) for i in range(150)]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1]), (None, rows[6][1]), (200, [-7.25] * 64)]
    bad = [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 128), (304, [None] + [0.5] * 63)]
    bad += [(305, [float("nan")] + [0.5] * 63), (306, [float("inf")] + [0.5] * 63)]
    return rows, bad


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def test_against_brute_force(spark):
    rows, bad = _odd(1)
    table = _table(spark, rows + bad).selectExpr("*", "9 AS cluster", "9 AS distance", "9 AS v")
    found, centroids = clusters.cluster(clusters.whole_vectors(table))
    wanted, means = _brute(rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == wanted
    assert centroids.tolist() == means
    for k, rounds in ((3, 1), (500, 2)):
        found, centroids = clusters.cluster(clusters.whole_vectors(table), k=k, rounds=rounds)
        wanted, means = _brute(rows, k, rounds)
        assert sorted((tuple(r) for r in found.collect()), key=str) == wanted
        assert centroids.tolist() == means


def test_search_by_levels_finds_the_nearest():
    rng = random.Random(2)
    vectors = clusters.np.array([[rng.randint(-99, 99) for _ in range(64)] for _ in range(300)])
    centroids = clusters.np.concatenate([vectors[:40], vectors[:5], vectors[:9] + 1])
    number, distance = clusters.nearest(clusters.transformed(vectors), clusters.transformed(centroids))
    all_of = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == all_of.argmin(axis=1)).all() and (distance == all_of.min(axis=1)).all()


def test_no_vectors_and_numbers_too_large(spark):
    found, centroids = clusters.cluster(clusters.whole_vectors(_table(spark, [(1, None)])))
    assert found.count() == 0 and len(centroids) == 0
    with pytest.raises(Exception, match="beyond"):
        clusters.whole_vectors(_table(spark, [(1, [1e30] * 64)])).collect()


def test_registered_query_against_sql(spark, duck, tmp_path):
    rows, bad = _odd(4)
    folder = str(tmp_path)
    _table(spark, rows + bad).write.parquet(f"{folder}/embeddings.parquet")
    for where, pattern in ((SF_DIR, "embeddings.parquet"), (folder, "embeddings.parquet/*.parquet")):
        duck.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{where}/{pattern}'")
        wanted = duck.sql(CENTROIDS)
        found = LLM_QUERIES["op12_centroids"](spark, where)
        assert found.columns == wanted.columns
        assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(wanted.fetchall(), key=str)


def test_registered_query_over_no_vectors(spark, tmp_path):
    _table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert LLM_QUERIES["op12_centroids"](spark, str(tmp_path)).count() == 0
