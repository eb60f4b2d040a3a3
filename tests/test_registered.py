"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from market_support import FOLDER

import __spark_entry__ as entry
from depthbook.plans import catalog, oracle

QUERIES, ORACLES = catalog.queries(), oracle.oracle_sql()
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan
    columns = sorted(frame.columns)
    found = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=repr)
    assert found == expected


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
