"""What reaches the scans, and how many shuffles a plan has."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark.operators import compare
from tallymark.plans import activity, queries, sales
from tallymark.sources.tables import load

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, filters",
    [
        ("season_matched", ["GreaterThanOrEqual(o_orderdate,1999-04-01", "LessThan(o_orderdate,2000-09-01"]),
        ("expected_trend", ["GreaterThanOrEqual(o_orderdate,1999-04-01", "LessThan(o_orderdate,2000-09-01"]),
        ("account_measures_by_segment", ["GreaterThanOrEqual(o_orderdate,1996-10-01"]),
        ("keyword_candidates", ["EqualTo(toxic,0)"]),
        ("mom_change", ["GreaterThanOrEqual(o_orderdate,2001-07-01", "LessThan(o_orderdate,2001-08-01"]),
    ],
)
def test_filters_reach_the_scan(spark, name, filters):
    text = plan(spark, name)
    for wanted in filters:
        assert wanted in text


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("date_extent", "orders", "o_orderdate"),
        ("duplicate_keys", "lineitem", "l_orderkey,l_linenumber"),
        ("representative_text", "documents", "doc_id,text"),
        ("attributes_left_join", "documents", "doc_id,lang,n_chars"),
        ("inline_labels", "events", "event_type,value"),
    ],
)
def test_scans_read_only_the_columns_they_need(spark, name, table, columns):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/" + table + r"\.parquet", plan(spark, name))
    assert scans
    for scan in scans:
        assert ",".join(column.split("#")[0] for column in scan.split(",")) == columns


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("note_phrases", 0),
        ("licence_grants", 0),
        ("representative_text", 1),
        ("duplicate_keys", 1),
        ("fiscal_periods", 1),
        ("category_profile", 1),
    ],
)
def test_number_of_hash_shuffles(spark, name, shuffles):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == shuffles


def test_top_rows_need_no_full_sort(spark):
    for name in ("preview_ordered", "mixed_order_topk", "encounter_preview"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_a_count_by_segment_reads_no_lines(spark):
    assert "lineitem.parquet" not in plan(spark, "segment_contribution")
    assert "lineitem.parquet" in plan(spark, "segment_financial_change")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_each_comparison_cuts_the_lines_before_it_adds_them_up(spark, name):
    text = plan(spark, name)
    if name in ("mom_change", "yoy_change", "mtd_matched_days", "season_changes", "headline"):
        assert "LeftSemi" in text
        # A range for each side: the gap between them is not read.
        assert len(re.findall(r"GreaterThanOrEqual\(o_orderdate,\d", text)) >= 2 and "Or(" in text


def test_lines_that_are_summed_follow_the_chosen_accounts(spark):
    folder = "/root/testdata/sf0.1"
    last, kinds = queries.last_discharge(spark, folder), [compare.month_over_month()]
    chosen = queries.needed_accounts(spark, folder, last, kinds)
    lines = load(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "k")
    wanted = chosen.select(F.col("hospital_account_id").alias("k")).distinct()
    assert sales.financials(spark, folder, chosen).count() == lines.join(wanted, "k", "left_semi").select("k").distinct().count()
    assert wanted.count() < load(spark, folder, "orders").count() / 20


def test_orphans_read_each_table_once(spark):
    text = plan(spark, "orphans")
    for table in ("orders", "lineitem", "documents", "labels"):
        assert len(re.findall(rf"FileScan[^\n]*/{table}\.parquet", text)) == 1


@pytest.mark.parametrize("name", ["two_week_compare", "rate_point_change", "gap_contribution", "rate_contribution", "rate_slices"])
def test_weeks_are_cut_where_events_are_read(spark, name):
    last, kinds = dt.date(2024, 1, 30), [compare.latest_weeks(2, "two_weeks")]
    chosen = compare.in_any_window(F.col("ts"), last, kinds, "timestamp_ntz")
    text = activity.encounters(spark, FOLDER, chosen)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"GreaterThanOrEqual\(ts,2024-01-\d\d", text)) == 2 and "Or(" in text
    if name != "rate_slices":  # its rows are written on the way
        assert re.search(r"PushedFilters: [^\n]*GreaterThanOrEqual\(ts,", plan(spark, name))


def test_only_the_notes_of_chosen_weeks_are_read_for_evidence(spark):
    assert "LeftSemi" in plan(spark, "two_week_compare") and "LeftSemi" not in plan(spark, "patient_period_gold")


def test_a_number_of_two_does_not_run_into_the_next(spark):
    rows = spark.createDataFrame([(1, 0), (1, 999_999), (2, 0), (2, None)], "a long, b long")
    assert [r[0] for r in rows.select(activity.numbered(F.col("a"), F.col("b"))).collect()] == [10**6, 2 * 10**6 - 1, 2 * 10**6, None]
    for wrong in (10**6, -1):
        with pytest.raises(PySparkException):
            spark.range(1).select(activity.numbered(F.col("id"), F.lit(wrong))).collect()


def test_levels_read_each_table_once(spark):
    text = plan(spark, "account_levels")
    for table in ("orders", "lineitem", "customer"):
        assert len(re.findall(rf"FileScan[^\n]*/{table}\.parquet", text)) == 1


def test_windows_need_no_nested_loop(spark):
    text = plan(spark, "rolling_windows")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert re.search(r"PushedFilters: [^\n]*o_orderdate", text)
