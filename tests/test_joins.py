from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks, joins


def facts(spark, hot=4_000, cold=6_000):
    """A third of the rows and more on one key, some on NULL, the rest spread."""
    key = F.when(F.col("id") < hot, F.lit(7)).when(F.col("id") < hot + 1_500, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(hot + 1_500 + cold).select(F.col("id").alias("row"), key.cast("long").alias("k"))


def dimension(spark):
    return spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("value"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_are_the_same_with_and_without_broadcast(spark, how):
    """A third of the rows and more on one key; the join is one and the same at every size."""
    left, right = facts(spark), dimension(spark)
    wanted = Counter(map(tuple, joins.join_dimension(left, right, "k", how).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.join_dimension(left, right, "k", how)
        assert Counter(map(tuple, joined.collect())) == wanted
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        joins.join_dimension(left, right, "k", "full")


def test_only_the_detail_of_some_parents(spark):
    parents = spark.createDataFrame([(7,), (7,), (3,), (None,)], "k long")
    found = joins.only_of(facts(spark), parents, "k")
    assert found.count() == facts(spark).where("k in (3, 7)").count()
    assert found.columns == ["k", "row"] or found.columns == ["row", "k"]


def test_join_grain_matches_the_real_join(spark):
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "p int")
    child = spark.createDataFrame([(1,), (1,), (1,), (3,), (9,), (None,)], "c int")
    joined = parent.join(child, F.col("p") == F.col("c"), "left")
    row = checks.join_grain(parent, child, "p", "c").first()
    assert row.rows_after_join == joined.count() == 9
    assert row.distinct_parents == 3
    assert (row.parents_with_many, row.parents_without) == (1, 2)


def test_orphans_are_the_keys_of_an_anti_join(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "a")], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "px int, py string")
    found = checks.orphans(child, parent, {"x": "px", "y": "py"})
    assert Counter(tuple(r) for r in found.collect()) == Counter([(2, "a", 1), (None, "a", 1)])
