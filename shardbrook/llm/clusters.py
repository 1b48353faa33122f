"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

Vectors and centroids of 64 whole numbers go through the exact transform; it keeps
squared distances but for a factor of 64.  Differences are added up from coarse
coefficients to fine ones, and a centroid is left out of a vector's search once what it
has gathered is more than another centroid can end with.  Whoever is left finishes all 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 64

# Numbers beyond this could overflow the transform's squares.
LIMIT = 1 << 20

# Ends of the steps from coarse to fine.
_LEVELS = (1, 2, 4, 8, 16, 32, 64)

# Vectors searched at once.
_BLOCK = 2048


def whole_vectors(
    table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = DIM
) -> DataFrame:
    """``id_col, v``: usable vectors in whole numbers, floor(scale * x).

    Usable are those with exactly 64 components, none null or non-finite; others take no
    part.  A number beyond ``LIMIT`` fails the job.
    """
    real = F.transform(vector_col, lambda x: x.cast("double"))
    usable = (F.size(vector_col) == DIM) & F.forall(
        real, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))
    )

    def number(x: Column) -> Column:
        scaled = F.floor(x * F.lit(float(scale)))
        refuse = F.raise_error(F.lit(f"a component beyond {LIMIT}")).cast("long")
        return F.when(F.abs(scaled) <= LIMIT, scaled).otherwise(refuse)

    return table.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col), F.transform(real, number).alias("v")
    )


def _hadamard() -> np.ndarray:
    """The transform's matrix, coarse rows (few changes of sign) first."""
    matrix = np.ones((1, 1))
    while len(matrix) < DIM:
        matrix = np.kron(matrix, np.array([[1.0, 1.0], [1.0, -1.0]]))
    changes = (np.diff(matrix, axis=1) != 0).sum(axis=1)
    return matrix[np.argsort(changes, kind="stable")]


def transformed(vectors: np.ndarray) -> np.ndarray:
    """Coefficients as exact integers: products of floats below 2^53."""
    return (vectors.astype(np.float64) @ _hadamard().T).astype(np.int64)


def _rests(coefficients: np.ndarray) -> dict[int, np.ndarray]:
    """What the squares of the coefficients from each level on add up to."""
    squares = coefficients * coefficients
    return {end: squares[:, end:].sum(axis=1) for end in _LEVELS}


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest row of ``centroids`` (the smaller on a tie), squared distance.

    Both are transformed already.
    """
    n, k = len(vectors), len(centroids)
    rest, rest_of = _rests(vectors), _rests(centroids)
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    gathered = np.zeros(n * k, dtype=np.int64)
    low = 0
    for high in _LEVELS:
        step = vectors[row, low:high] - centroids[number, low:high]
        gathered += np.einsum("ij,ij->i", step, step)
        if high < DIM:
            # (a - b)^2 is at most 2 (a^2 + b^2).
            most = gathered + 2 * (rest[high][row] + rest_of[high][number])
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            best = np.minimum.reduceat(most, starts)[row]
            stays = gathered <= best
            row, number, gathered = row[stays], number[stays], gathered[stays]
        low = high
    order = np.lexsort((number, gathered, row))
    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return number[first], gathered[first] // DIM


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)


def _searched(batch: pa.RecordBatch, column: str, targets: np.ndarray) -> Iterator[tuple]:
    """Blocks of a batch: where it starts, its vectors, their numbers and distances."""
    for start in range(0, batch.num_rows, _BLOCK):
        vectors = _matrix(batch.slice(start, _BLOCK).column(column))
        yield start, vectors, *nearest(transformed(vectors), targets)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vectors`` without ``v``, and the nearest centroid (``cluster``, ``distance``)."""
    targets = transformed(centroids)
    kept = [c for c in vectors.columns if c not in ("v", "cluster", "distance")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, found, number, distance in _searched(batch, "v", targets):
                part = batch.slice(start, len(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                    names=[*kept, "cluster", "distance"],
                )

    schema = T.StructType(
        [vectors.schema[c] for c in kept]
        + [T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    return vectors.select(*kept, "v").mapInArrow(run, schema)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: componentwise floor of the means of their vectors.

    Every task adds up its own vectors and gives one row for each centroid; those few
    rows are shuffled.  A centroid without vectors stays.
    """
    targets = transformed(centroids)
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, DIM), dtype=np.int64)
        for batch in batches:
            for _, found, number, _ in _searched(batch, "v", targets):
                counts += np.bincount(number, minlength=k)
                np.add.at(sums, number, found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(counts), pa.array(list(sums), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = vectors.select("v").mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIM)]
    )
    after = centroids.copy()
    for row in totals.where("n > 0").collect():  # one row a centroid
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(DIM)]
    return after


def seeds(vectors: DataFrame, k: int, id_col: str = "vec_id", salt: str = "1") -> np.ndarray:
    """The vectors with the smallest SHA-256 of salt and id; equal ids by their numbers."""
    named = F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("string")).cast("binary")
    first = vectors.select("v").orderBy(F.asc_nulls_last(F.sha2(named, 256)), "v").limit(k)
    return np.array([r["v"] for r in first.collect()], dtype=np.int64).reshape(-1, DIM)


def learn(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id") -> np.ndarray:
    """Centroids of ``vectors`` after some rounds; fewer than ``k`` if there are fewer vectors."""
    centroids = seeds(vectors, k, id_col)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def digest(centroid: np.ndarray) -> str:
    """SHA-256 of a centroid's components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame, *, k: int = 16, rounds: int = 3, id_col: str = "vec_id"
) -> tuple[DataFrame, np.ndarray]:
    """``id_col, cluster, distance`` (squared) for every row of ``whole_vectors``, and the centroids.

    Repeated rows and ids are vectors of their own; a null id never seeds while there
    are others.  Without vectors there are no rows and no centroids.
    """
    centroids = learn(vectors, k, rounds, id_col)
    return assign(vectors.select(id_col, "v"), centroids), centroids
