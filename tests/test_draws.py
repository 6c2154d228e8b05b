"""Keyed draws and what is sampled with them."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions.draws import STEPS, draw_steps, uniform
from tallymark.operators import derive


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_draws_depend_on_seed_salt_and_key_only(spark, method):
    frame = spark.range(2_000)
    first = {r.id: r.u for r in frame.select("id", uniform("a", "id", method=method).alias("u")).collect()}
    again = {r.id: r.u for r in frame.repartition(7).select("id", uniform("a", "id", method=method).alias("u")).collect()}
    assert first == again and all(0 <= u < 1 for u in first.values())
    other = {r.id: r.u for r in frame.select("id", uniform("b", "id", method=method).alias("u")).collect()}
    assert sum(first[i] == other[i] for i in first) < 20
    assert abs(sum(first.values()) / 2_000 - 0.5) < 0.03


def test_errors(spark):
    with pytest.raises(ValueError):
        draw_steps("a")
    with pytest.raises(ValueError):
        draw_steps("a", F.lit(1), method="rand")
    assert spark.range(1).select(draw_steps("a", F.lit(1))).first()[0] < STEPS


def test_sample_outside_panel_and_cutoff(spark):
    import datetime as dt

    frame = spark.range(3_000)
    share = derive.keyed_sample(frame, "s", ["id"], 0.1).count() / 3_000
    assert 0.07 < share < 0.13
    with pytest.raises(ValueError):
        derive.keyed_sample(frame, "s", ["id"], 1.5)
    rows = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, inside boolean")
    assert [r.id for r in derive.outside(rows, F.col("inside")).collect()] == [2]
    panel = derive.month_panel(rows.select("id"), dt.date(2024, 11, 1), 3)
    assert panel.count() == 9 and str(panel.agg(F.max("reporting_month")).first()[0]) == "2025-01-01"
    with pytest.raises(ValueError):
        derive.month_panel(rows, dt.date(2024, 11, 1), 0)
    assert derive.as_of(panel, "reporting_month", dt.date(2024, 12, 1)).count() == 6
