"""Exact top-k inner products by norm buckets.

Vectors are grouped by length (norm) into buckets of bounded size.  A first round
over the longest bucket gives each query a floor under its k-th best score.  For
every other bucket that floor becomes a local cosine threshold, floor / (length of
the query * longest vector of the bucket): above 1 the bucket is skipped; low ones
leave only length pruning (vectors too short to reach the floor); high ones add
coordinate pruning (a vector whose share of the query's strongest coordinates cannot
reach the threshold, whatever its other coordinates are).  Products of what is left
are verified in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.storage import store

# A local cosine threshold above this is worth looking at coordinates.
COORDINATE_COSINE = 0.6
FOCUS = 16  # strongest coordinates of a query that coordinate pruning looks at


def whole_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """``id, v, norm, dim``: each component as ``floor(scale * x)``.

    Rows with a null id or vector, or a null or non-finite component, take no part;
    neither do empty vectors.
    """
    x = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & F.coalesce(F.size(x) > 0, F.lit(False))
        & F.forall(
            x,
            lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))),
        )
    )
    return (
        vectors.where(usable)
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
        )
        .withColumn(
            "norm",
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)),
        )
        .withColumn("dim", F.size("v"))
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number inner products; by floating point where that is exact."""
    if not len(left) or not len(right):
        return np.zeros((len(left), len(right)), dtype=np.int64)
    largest = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    if largest < 2.0**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def best_of_bucket(
    query_ids: np.ndarray,
    queries: np.ndarray,
    floors: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
) -> Iterator[tuple[int, int, int]]:
    """``query, vector, score``: up to k best of one bucket for each query.

    Scores below a query's floor may be left out; none at or above it is.
    """
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    ids, vectors, norms = ids[order], vectors[order], norms[order]
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    longest = float(norms[0])
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(
            lengths * longest > 0, floors / (lengths * longest), np.where(floors > 0, np.inf, -1.0)
        )
    slack = 1.0 - 1e-9  # bounds are in floating point; products are exact
    coordinate = cosine > COORDINATE_COSINE

    def top(rows: np.ndarray, who: np.ndarray, columns: np.ndarray) -> Iterator[tuple]:
        """rows: scores of the queries ``who`` against the vectors ``columns``."""
        names = ids[columns]
        for r, q in enumerate(who):
            scores = rows[r]
            keep = (scores >= floors[q]) & (names != query_ids[q])
            scores, found = scores[keep], names[keep]
            if len(scores) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= least
                scores, found = scores[near], found[near]
            best = np.lexsort((found, -scores))[:k]
            for b in best:
                yield int(query_ids[q]), int(found[b]), int(scores[b])

    plain = np.flatnonzero(~coordinate)
    for start in range(0, len(plain), 256):
        who = plain[start : start + 256]
        # Length pruning: vectors are sorted, so those long enough come first.
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(lengths[who] > 0, floors[who] * slack / lengths[who], -1.0)
        reach = int(np.searchsorted(-norms, -needed.min(), side="right"))
        yield from top(products(queries[who], vectors[:reach]), who, np.arange(reach))
    for q in np.flatnonzero(coordinate & (cosine * slack <= 1.0)):
        need = floors[q] * slack
        reach = int(np.searchsorted(-norms, -need / lengths[q], side="right"))
        strongest = np.argsort(-np.abs(queries[q]), kind="stable")[:FOCUS]
        part = vectors[:reach, strongest].astype(np.float64)
        rest_q = lengths[q] ** 2 - (queries[q][strongest].astype(np.float64) ** 2).sum()
        rest_v = norms[:reach] ** 2 - (part**2).sum(axis=1)
        bound = part @ queries[q][strongest].astype(np.float64) + np.sqrt(
            np.maximum(rest_q, 0.0) * np.maximum(rest_v, 0.0)
        )
        left = np.flatnonzero(bound >= need - 1e-6 * abs(need))
        who = np.array([q])
        yield from top(products(queries[who], vectors[left]), who, left)


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    bucket_rows: int = 8192,
    query_block: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest products of each query.

    Both tables come from ``whole_vectors``.  A query meets every vector of its own
    dimension but the rows that carry its own id; ties go to the smaller id, and
    equal rows rank side by side.  Queries with one id count once (the first vector
    by value).  Fewer than k vectors give fewer rows, empty tables none.

    Vectors are dealt by norm into buckets of about ``bucket_rows``, queries into
    blocks of at most about ``query_block``; a task joins one block with one dimension of
    one bucket, and sends on at most k rows for each query of it.
    """
    vectors = store(vectors, "vectors")
    queries = store(
        queries.groupBy("id").agg(F.min_by(F.struct("v", "norm", "dim"), "v").alias("q")).select(
            "id", "q.*"
        ),
        "queries",
    )
    n_vectors, n_queries = vectors.count(), queries.count()
    n_buckets = max(1, -(-n_vectors // bucket_rows))
    n_blocks = max(1, -(-n_queries // query_block))

    # Sort by length; equal lengths are dealt by id, so no bucket is a single length's.
    bucketed = store(
        vectors.repartitionByRange(n_buckets, F.desc("norm"), F.xxhash64("id")).withColumn(
            "bucket", F.spark_partition_id().cast("long")
        ),
        "buckets",
    )
    lists = bucketed.groupBy("dim", "bucket").agg(F.max("norm").alias("longest"))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))

    def joined(pairs: DataFrame) -> DataFrame:
        """Best rows of each bucket for the queries (with floors) paired with it."""
        by, of = ["dim", "bucket", "block"], ["of_dim", "of_bucket", "of_block"]
        left = pairs.select(*by, "id", "v", "floor")
        used = left.select(*by).distinct().toDF(*of)
        there = (F.col("dim") == F.col("of_dim")) & (F.col("bucket") == F.col("of_bucket"))
        right = bucketed.join(used, there).select(
            *of, F.col("id").alias("vec"), F.col("v").alias("w")
        )
        return (
            left.groupBy(*by)
            .cogroup(right.groupBy(*of))
            .applyInArrow(run, "query_id long, vec_id long, score long")
        )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            rows = list(
                best_of_bucket(
                    left["id"].to_numpy(),
                    _matrix(left["v"].combine_chunks()),
                    left["floor"].to_numpy(),
                    right["vec"].to_numpy(),
                    _matrix(right["w"].combine_chunks()),
                    k,
                )
            )
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)}
        )

    # Floors: the longest bucket of each dimension, against all queries of it.
    nothing = F.lit(float("-inf"))
    first = lists.groupBy("dim").agg(F.max_by("bucket", F.struct("longest", "bucket")).alias("bucket"))
    opening = store(joined(blocked.join(first, "dim").withColumn("floor", nothing)), "opening")
    floors = (
        opening.groupBy("query_id")
        .agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
        .select(
            F.col("query_id").alias("id"),
            F.when(F.size("s") >= k, F.element_at("s", k).cast("double")).alias("floor"),
        )
    )
    others = lists.join(first, ["dim", "bucket"], "left_anti")
    rest = (
        blocked.join(floors, "id", "left")
        .withColumn("floor", F.coalesce("floor", nothing))
        .join(others, "dim")
        .where(F.col("norm") * F.col("longest") >= F.col("floor") * (1 - 1e-9))
    )
    best = opening.unionByName(joined(rest))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
