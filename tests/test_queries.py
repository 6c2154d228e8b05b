"""Every registered query against its SQL, and what every plan must not contain."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tallymark.plans.queries import QUERIES, TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    found = frame.collect()
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    columns = sorted(frame.columns)
    assert columns == sorted(names)
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    actual = [tuple(row[c] for c in columns) for row in found]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    assert not any(isinstance(v, float) and math.isnan(v) for row in actual for v in row)
