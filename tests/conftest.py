import datetime
import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Workers import the processors defined in test modules.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(HERE), str(HERE.parent), os.environ.get("PYTHONPATH", "")]
)

from shardbrook.schema import LEASE_EVENT, PROGRESS, RECORD, SAMPLE  # noqa: E402
from shardbrook.session import build_session  # noqa: E402
from shardbrook.sources.log import as_records  # noqa: E402

START = datetime.datetime(2024, 1, 1)


def at(seconds: float) -> datetime.datetime:
    return START + datetime.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Small tables of the package's layouts."""

    class Make:
        @staticmethod
        def records(rows, stream="s"):
            """Rows of (shard, sequence number, second, payload)."""
            raw = spark.createDataFrame(
                [(s, q, "key", d, at(t)) for s, q, t, d in rows],
                "shard_id string, sequence_number string, partition_key string, "
                "data binary, arrival_ts timestamp",
            )
            return as_records(raw, stream)

        @staticmethod
        def progress(rows):
            """Rows of (shard, checkpoint, owner, closed, claim)."""
            return spark.createDataFrame(
                [("s", s, q, o, None, None, c, r) for s, q, o, c, r in rows], PROGRESS
            )

        @staticmethod
        def samples(rows):
            return spark.createDataFrame(
                [("s", shard, at(t), metric, float(v)) for shard, t, metric, v in rows], SAMPLE
            )

        @staticmethod
        def leases(rows):
            """Rows of (id, shard, worker, second, kind)."""
            return spark.createDataFrame(
                [("s", shard, w, at(t), kind, i) for i, shard, w, t, kind in rows],
                LEASE_EVENT.simpleString()[7:-1].replace(":", " ") + ", event_id bigint",
            )

        schema = RECORD

    return Make


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)
