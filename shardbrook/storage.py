"""Small intermediate tables, written once to the folder all executors share.

A per-shard table (progress, tips) that is derived from the whole log is
written before it is joined back.  That cuts the lineage, survives the loss of
executors, and gives Catalyst the true size of the table: it is broadcast only
when the files are under ``spark.sql.autoBroadcastJoinThreshold``, and joined by
shuffle beyond that.  No broadcast hint is used anywhere in this package.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _scratch(spark: SparkSession) -> str:
    """This application's folder below the session's checkpoint folder, or its warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/shardbrook/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path that the driver and all executors share."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables that ``store`` and ``shared_dir`` placed for this application.

    Results that still read them can not be used any more.
    """
    remove(spark, _scratch(spark))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_if_present(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_once(
    spark: SparkSession, path: str, schema, build: Callable[[], DataFrame]
) -> DataFrame:
    """The table at ``path``; built and written there the first time only.

    A marker written after the rows tells a whole table from the remains of a
    write that was cut short.
    """
    rows, marker = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/done"
    done = read_if_present(spark, marker, "done boolean")
    if done is None or done.isEmpty():
        build().write.mode("overwrite").parquet(rows)
        spark.sql("SELECT true AS done").write.mode("overwrite").parquet(marker)
    return spark.read.schema(schema).parquet(rows)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(context._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, wherever Spark's paths may lie."""
    there, files = _file_system(spark, path)
    if not files.exists(there):
        return []
    return [f.getPath().getName() for f in files.listStatus(there) if f.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's paths may lie."""
    there, files = _file_system(spark, path)
    files.delete(there, True)
