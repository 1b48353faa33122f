"""Every registered query gives what its SQL twin gives in DuckDB."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from shardbrook.plans.oracles import ORACLES
from shardbrook.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        [
            str(round(row[i], 6) if isinstance(row[i], float) else row[i])
            for i in order
        ]
        for row in rows
    )


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    result = entry_points.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    expected = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    found = _normal(result.collect(), result.columns)
    assert found == _normal(expected.fetchall(), expected.columns)
    assert found, "a query over the whole table finds something"


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4


def test_ordered_handoff_needs_nothing_on_the_workers(tmp_path):
    """The package is importable on the driver only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from shardbrook.session import build_session\n"
        "spark = build_session('x', 'local[2]', spark_ui_enabled='false')\n"
        f"print('rows', e.queries()['handoff_ordered'](spark, {SF_DIR!r}).count())\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code],
        cwd=tmp_path,
        env=environment,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "rows 10000" in done.stdout, done.stderr[-2000:]
