"""Every registered query beside its SQL, on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from check import TABLES, digest

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_keys():
    own = {name for name in registered.queries() if name in registered.QUERIES}
    assert own <= set(registered.oracle_sql())


def test_oracle_needs_no_spark():
    """The SQL is at hand in a process where PySpark cannot be imported."""
    code = "import sys; sys.modules['pyspark.ml'] = None; from registry import oracle; "
    code += "assert len(oracle.statements()) > 40"
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


@pytest.mark.parametrize("name", sorted(set(registered.oracle_sql()) & set(registered.QUERIES)))
def test_query_equals_sql(spark, duck, name):
    frame = registered.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = duck.execute(registered.oracle_sql()[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    places = [order.index(c) for c in columns]
    theirs = [tuple(row[i] for i in places) for row in result.fetchall()]
    ours = [tuple(row) for row in frame.select(*columns).collect()]
    assert ours and digest(ours) == digest(theirs)


def test_entry(spark):
    assert registered.entry(spark).columns == ["period", "w1", "w2", "npmi"]
