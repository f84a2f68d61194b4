"""Every registered query against DuckDB on the smallest test data."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import _core_queries as queries
from __spark_entry__ import entry
from oracle_queries import ORACLE

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test data is not installed")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    result = queries()[name](spark, str(SF_DIR))
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(result.columns)
    want = normal(columns, expected.fetchall())
    assert normal(result.columns, result.collect()) == want
    # A check or report that returns nothing would compare equal to anything empty.
    assert want
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


def test_entry(spark):
    assert entry(spark).columns == ["order_date", "total_revenue", "order_count", "distinct_user_count", "average_order_value"]
