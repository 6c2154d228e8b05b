"""A full refresh puts checked rows in the place of old ones, or leaves those."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark.operators import checks
from tallymark.sources import staging, tables


@pytest.fixture()
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS refresh")
    spark.sql("DROP TABLE IF EXISTS refresh.rows")
    tables.write_full(spark.range(10), "refresh.rows")
    return "refresh.rows"


def left(spark):
    return sorted(t.name for t in spark.catalog.listTables("refresh"))


def test_a_failing_write_keeps_the_old_rows(spark, table):
    broken = spark.range(100).withColumn("x", F.when(F.col("id") == 57, F.raise_error(F.lit("broken row")).cast("int")))
    with pytest.raises(PySparkException):
        tables.write_full(broken, table)
    assert spark.table(table).count() == 10 and left(spark) == ["rows"]


def test_rows_that_fail_their_check_are_not_published(spark, table):
    twice = spark.range(5).union(spark.range(5))
    with pytest.raises(AssertionError):
        tables.write_full(twice, table, check=lambda staged: checks.require_empty(checks.duplicates(staged, "id"), "twice"))
    assert spark.table(table).count() == 10 and left(spark) == ["rows"]
    tables.write_full(spark.range(3), table, check=lambda staged: checks.require_empty(checks.duplicates(staged, "id"), "twice"))
    assert spark.table(table).count() == 3 and left(spark) == ["rows"]


def test_a_table_can_be_refreshed_from_itself(spark, table):
    tables.write_full(spark.table(table).where("id % 2 = 0"), table)
    assert sorted(r.id for r in spark.table(table).collect()) == [0, 2, 4, 6, 8]


@pytest.mark.parametrize("new_is_there", [False, True])
def test_a_swap_that_stopped_halfway_is_put_right(spark, table, new_is_there):
    spark.sql("ALTER TABLE refresh.rows RENAME TO refresh.rows__before")
    spark.range(2).write.saveAsTable("refresh.rows" if new_is_there else "refresh.rows__staged")
    staging.recover(spark, table)
    assert spark.table(table).count() == (2 if new_is_there else 10) and left(spark) == ["rows"]


def test_buckets(spark, table):
    tables.write_full(spark.range(20).withColumnRenamed("id", "k"), table, "k", 4)
    assert spark.table(table).count() == 20
    tables.write_full(spark.range(30).withColumnRenamed("id", "k"), table, "k", 4)
    plan = spark.table(table).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and spark.table(table).count() == 30
    with pytest.raises(ValueError):
        tables.write_full(spark.range(1), table, "id")


def test_inline_rows_need_no_python(spark):
    frame = tables.inline_table(spark, [(1, "a", None), (2, None, 2.5)], "id BIGINT, name STRING, v DOUBLE")
    assert sorted(map(tuple, frame.collect())) == [(1, "a", None), (2, None, 2.5)]
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint", "string", "double"]
    assert "PythonRDD" not in frame._jdf.rdd().toDebugString() and "ExistingRDD" not in frame._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        tables.inline_table(spark, [(1,), (1, 2)], "id INT")
