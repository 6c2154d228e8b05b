"""Every registered query of the subpackage that SQL can express, against its SQL."""

import pytest

import __spark_entry__ as contract
from tallymark.llm import oracles, queries

SMALL = "/root/testdata/sf0.001"
NATIVE = ("op2_chat_windows", "op3_quality", "op8_mixing")


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, SMALL)
    cursor = duck.execute(oracles.ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    expected = [tuple(row[names.index(c)] for c in frame.columns) for row in cursor.fetchall()]
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plans(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in NATIVE:
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_read_no_rows_made_in_python(spark, name):
    frame = queries.QUERIES[name](spark, SMALL)
    assert "PythonRDD" not in frame._jdf.rdd().toDebugString()
    assert "ExistingRDD" not in frame._jdf.queryExecution().executedPlan().toString()
