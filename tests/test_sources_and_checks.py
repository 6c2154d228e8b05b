import pytest
from pyspark.sql import functions as F

from tallymark.functions.draws import uniform
from tallymark.operators import checks, conform, evidence
from tallymark.plans import fixed_values as fixed
from tallymark.sources import tables


def test_full_refresh_twice_and_with_another_schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS reporting")
    frame = tables.spine(spark, 50, "id", 1).withColumn("u", uniform("a", "id"))
    tables.write_full(frame, "reporting.rows")
    first = sorted(tables.scan(spark, "rows", "reporting").collect())
    tables.write_full(frame, "reporting.rows")
    assert sorted(spark.table("reporting.rows").collect()) == first and len(first) == 50
    tables.write_full(frame.select("id", F.lit("x").alias("label")), "reporting.rows")
    assert spark.table("reporting.rows").columns == ["id", "label"]
    found = tables.query_table(
        spark, "SELECT COUNT(*) AS n FROM IDENTIFIER(:source_schema || '.rows')", source_schema="reporting"
    )
    assert found.first().n == 50
    counts = tables.manifest({"rows": spark.table("reporting.rows"), "none": spark.range(0).toDF("id")})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"rows": 50, "none": 0}


def test_inline_table_is_bounded(spark):
    frame = tables.inline_table(spark, [(1, "a")], "id INT, name STRING")
    assert [tuple(r) for r in frame.collect()] == [(1, "a")]
    with pytest.raises(ValueError):
        tables.inline_table(spark, [], "id INT")
    with pytest.raises(ValueError):
        tables.inline_table(spark, [(n,) for n in range(tables.INLINE_LIMIT + 1)], "id INT")


def test_split_and_preview(spark):
    base = spark.createDataFrame([(1, "x", 3.0), (2, "y", 4.0)], "id int, name string, amount double")
    parts = conform.split(base, {"names": {"key": "id", "name": "name"}, "amounts": {"key": "id", "amount": "amount"}})
    assert parts["amounts"].columns == ["key", "amount"]
    with pytest.raises(ValueError):
        conform.split(base, {"x": {"a": "missing"}})
    top = conform.preview(base, ["id"], [F.desc("id")], 1)
    assert [r.id for r in top.collect()] == [2]


def test_unique_and_requirements(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert [tuple(r) for r in checks.duplicates(frame, "a", "b").collect()] == [(1, 2, 2)]
    with pytest.raises(AssertionError):
        checks.require_empty(checks.duplicates(frame, "a"), "a occurs twice")
    checks.require_empty(checks.duplicates(frame.distinct(), "a", "b"), "fine")


def test_numerators_within_denominators(spark):
    frame = spark.createDataFrame([("x", 1, 1), ("x", 0, 1), ("y", 1, 0), ("y", 0, 1)], "g string, n int, d int")
    found = {r.g: r for r in checks.numerators_within(frame, {"m": ("n", "d")}, ["g"]).collect()}
    assert found["x"].holds and (found["x"].numerator, found["x"].denominator) == (1, 2)
    assert not found["y"].holds and found["y"].violating_rows == 1
    with pytest.raises(AssertionError):
        checks.require_all(checks.numerators_within(frame, {"m": ("n", "d")}), "holds", "broken")


def test_expected_trend_needs_a_prior_value(spark):
    frame = spark.sql("SELECT explode(array(DATE'2025-04-01', DATE'2025-08-31', DATE'2026-05-05', DATE'2026-09-01', DATE'2025-03-31')) AS d")
    assert tuple(checks.expected_trend(frame, "d", 2026, (4, 8)).first()) == (2, 1, True)
    assert tuple(checks.expected_trend(frame, "d", 2025, (4, 8)).first()) == (0, 2, False)


def test_key_profile_and_profile_order(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 1), ("b", None)], "c string, k int")
    assert [tuple(r) for r in checks.key_profile({"t": (frame, "k")}).collect()] == [("t", 3, 1)]
    assert [r.c for r in checks.profile(frame, "c", F.count("*").alias("n"), order="n").collect()] == ["b", "a"]


def test_presence_finds_duplicates_and_orphans_in_one_pass(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (4,)], "p int")
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "c int")
    both = checks.presence({"parents": (parent, ["p"]), "children": (child, ["c"])})
    assert {r.p: (r.parents, r.children) for r in both.collect()} == {1: (1, 2), 2: (2, 0), 3: (0, 1), 4: (1, 0), None: (0, 1)}
    rules = {
        "parent twice": F.col("parents") > 1,
        "child alone": (F.col("children") > 0) & (F.col("parents") == 0),
    }
    found = {r.check: r.violations for r in checks.count_violations(both, rules).collect()}
    assert found == {"parent twice": 1, "child alone": 2}
    alone = checks.orphans(child, parent, {"c": "p"}).count()
    assert alone == found["child alone"]


def test_contrast_notes_are_labelled_right(spark):
    rows = [(i, note) for note in fixed.CONTRAST_NOTES for i in range(3)]
    notes = spark.createDataFrame([(n, text) for n, (_, text) in enumerate(rows)], "note_id int, note_text string")
    found = evidence.contrast_sample(notes, fixed.CONTRAST_NOTES, fixed.NOTE_RULES).orderBy("note_id").collect()
    assert [r.note_id for r in found] == [0, 3, 6, 9]
    assert [r.label for r in found] == ["provided", "not_provided", "not_provided", "not_provided"]


def test_tables_bucketed_alike_are_joined_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    tables.write_full(tables.spine(spark, 900, "id"), "bucketed.left", "id", 4)
    tables.write_full(tables.spine(spark, 900, "id").withColumn("x", F.lit(1)), "bucketed.right", "id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed.left").join(spark.table("bucketed.right"), "id")
        assert joined.count() == 900
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        tables.write_full(tables.spine(spark, 1, "id"), "bucketed.x", bucket_by="id")
