"""Every registered query runs, and equals its SQL where it has some."""

import pytest
from check_oracles import connect, spark_rows, sql_rows, types_match

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, FOLDER)
    columns, rows = spark_rows(df)
    assert rows
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        assert (columns, rows) == sql_rows(tables, ORACLES[name])
        assert not types_match(df, tables, ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 10
