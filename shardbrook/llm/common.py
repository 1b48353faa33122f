"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of results that a task holds before it hands them to Spark.
FLUSH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; a null one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """True for documents whose labels no model may see; a null id is held out."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(True))


def settled(df: DataFrame) -> DataFrame:
    """The same rows, with columns that are computed once whatever is done to them.

    A filter on a column is moved down to the scan, with all that the column is made
    of written out anew inside it, once for each place that uses it; with functions
    over arrays that multiplies.  Columns whose value depends on the row's place keep
    the filter above them.
    """
    row = F.when(F.monotonically_increasing_id() >= 0, F.struct(*df.columns))
    return df.select(row.alias("_settled")).select("_settled.*")


def map_rows(
    df: DataFrame,
    setup: Callable[[], Callable[[list], Iterator[tuple[tuple, int]] | list]],
    schema: T.StructType,
) -> DataFrame:
    """Map rows to rows in Python, in Arrow batches of bounded size.

    ``setup`` runs once in each task and returns the function that is applied to
    the columns of a batch (lists of values); that yields pairs of a row and its
    size in bytes.  Results leave the task as soon as ``FLUSH_BYTES`` are reached.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = setup()

        def out(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        rows, held = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for row, size in apply([c.to_pylist() for c in part.columns]):
                    rows.append(row)
                    held += size
                    if held >= FLUSH_BYTES or len(rows) >= 10_000:
                        yield out(rows)
                        rows, held = [], 0
        if rows:
            yield out(rows)

    return df.mapInArrow(run, schema)
