import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import compare, measures

D = dt.date.fromisoformat


def bounds(spark, comparison, last):
    row = spark.range(1).select(*comparison.bounds(F.lit(D(last)))).first()
    return [str(value) for value in row]


def test_windows_of_a_partial_month(spark):
    last = "2026-09-20"
    assert bounds(spark, compare.month_over_month(), last) == ["2026-08-01", "2026-08-31", "2026-07-01", "2026-07-31"]
    assert bounds(spark, compare.year_over_year(), last) == ["2026-08-01", "2026-08-31", "2025-08-01", "2025-08-31"]
    assert bounds(spark, compare.month_to_date(), last) == ["2026-09-01", "2026-09-20", "2025-09-01", "2025-09-20"]
    assert bounds(spark, compare.season(4), last) == ["2026-04-01", "2026-08-31", "2025-04-01", "2025-08-31"]
    half = ["2026-04-01", "2026-09-30", "2025-10-01", "2026-03-31"]
    assert bounds(spark, compare.latest_months(6, "h", partial=True), "2026-09-01") == half
    assert bounds(spark, compare.latest_months(6, "h"), "2026-09-30") == half
    assert bounds(spark, compare.latest_months(1, "h"), "2026-09-01") == ["2026-08-01", "2026-08-31", "2026-07-01", "2026-07-31"]


def test_windows_of_weeks(spark):
    assert bounds(spark, compare.latest_weeks(1, "w"), "2024-01-30") == ["2024-01-22", "2024-01-28", "2024-01-15", "2024-01-21"]
    assert bounds(spark, compare.latest_weeks(2, "w"), "2024-01-28") == ["2024-01-15", "2024-01-28", "2024-01-01", "2024-01-14"]
    with pytest.raises(ValueError):
        compare.latest_weeks(0, "w")


def test_windows_around_leap_days_and_year_ends(spark):
    assert bounds(spark, compare.month_to_date(), "2024-02-29") == ["2024-02-01", "2024-02-29", "2023-02-01", "2023-02-28"]
    assert bounds(spark, compare.year_over_year(), "2024-02-29") == ["2024-02-01", "2024-02-29", "2023-02-01", "2023-02-28"]
    assert bounds(spark, compare.year_over_year(), "2025-02-28") == ["2025-02-01", "2025-02-28", "2024-02-01", "2024-02-29"]
    assert bounds(spark, compare.month_over_month(), "2026-01-31") == ["2026-01-01", "2026-01-31", "2025-12-01", "2025-12-31"]
    assert bounds(spark, compare.season(11), "2026-01-31") == ["2025-11-01", "2026-01-31", "2024-11-01", "2025-01-31"]


ROWS = [
    # day, group, patient, amount, weight
    ("2026-08-05", "A", 1, "10.00", 1.0),
    ("2026-08-31", "A", 1, "20.00", 2.0),
    ("2026-07-31", "A", 2, "40.00", None),
    ("2026-08-02", "B", 3, "5.00", 3.0),
    ("2026-07-02", "C", 4, "7.00", 4.0),
    ("2025-08-31", "A", 5, "0.00", 5.0),
    ("2026-09-20", "A", 6, "1.00", 6.0),
    ("2025-09-21", "A", 7, "9.00", 7.0),
    ("2026-08-09", None, 8, "2.00", 8.0),
]
SET = (
    measures.count_rows("n"),
    measures.count_distinct("people", "patient"),
    measures.total("amount", "cash"),
    measures.average("weight_mean", "weight"),
)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(D(d), g, p, Decimal(a), w) for d, g, p, a, w in ROWS]
    return spark.createDataFrame(data, "day date, grp string, patient long, cash decimal(18,2), weight double")


def run(rows, *comparisons, dims=("grp",), last=None, chosen=SET):
    last = last or compare.extent(rows, "day")
    result = compare.compare(rows, chosen, "day", last, comparisons, dims)
    return {tuple(r[name] for name in ("comparison", *dims)): r for r in result.collect()}


def test_groups_on_one_side_are_kept(rows):
    found = run(rows, compare.month_over_month())
    assert set(found) == {("mom", "A"), ("mom", "B"), ("mom", "C"), ("mom", None)}
    a, b, c = (found[("mom", g)] for g in "ABC")
    assert (a.n, a.n_prior, a.n_change, a.n_percent) == (2, 1, 1, 100.0)
    assert (a.people, a.people_prior) == (1, 1)
    assert (a.amount, a.amount_prior, a.amount_change, a.amount_percent) == (30, 40, -10, -25.0)
    assert (a.weight_mean, a.weight_mean_prior, a.weight_mean_change) == (1.5, None, None)
    assert (b.n_prior, b.n_change, b.n_percent, b.weight_mean_prior) == (0, 1, None, None)
    assert (c.n, c.n_change, c.n_percent, c.amount, c.weight_mean) == (0, -1, -100.0, 0, None)
    assert (a.current_period, a.prior_period) == ("2026-08-01..2026-08-31", "2026-07-01..2026-07-31")


def test_overlapping_comparisons_in_one_pass(rows):
    several = [compare.month_over_month(), compare.year_over_year(), compare.month_to_date()]
    together = run(rows, *several)
    for one in several:
        for key, row in run(rows, one).items():
            assert together[key] == row
    mtd = together[("mtd", "A")]
    assert (mtd.n, mtd.n_prior, mtd.prior_period) == (1, 0, "2025-09-01..2025-09-20")
    assert together[("yoy", "A")].amount_percent is None  # a prior value of zero


def test_literal_last_date_gives_the_same_and_reaches_the_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert run(stored, compare.month_over_month(), last=D("2026-09-20")) == run(rows, compare.month_over_month())
    literal = compare.compare(stored, SET, "day", D("2026-09-20"), [compare.month_over_month()])
    last, kinds = compare.extent(stored, "day"), [compare.month_over_month()]
    needed = stored.where(compare.in_any_window(F.col("day"), last, kinds))
    subquery = compare.compare(needed, SET, "day", last, kinds)
    assert subquery.exceptAll(literal).isEmpty() and literal.exceptAll(subquery).isEmpty()
    assert "GreaterThanOrEqual(day,2026-07-01)" in plan(literal)
    cut = stored.where(compare.in_any_window(F.col("day"), compare.last_date(stored, "day"), kinds))
    assert cut.exceptAll(needed).isEmpty() and needed.exceptAll(cut).isEmpty()
    assert "Or(And(GreaterThanOrEqual(day,2026-08-01),LessThan(day,2026-09-01))" in plan(cut)
    assert "NestedLoop" not in plan(subquery) and "Cartesian" not in plan(subquery)


def test_the_gap_between_windows_is_left_out(rows):
    kinds = [compare.year_over_year(), compare.month_to_date()]
    for last in (compare.extent(rows, "day"), D("2026-09-20")):
        kept = rows.where(compare.in_any_window(F.col("day"), last, kinds)).select("day").collect()
        assert sorted(str(r.day) for r in kept) == ["2025-08-31", "2026-08-02", "2026-08-05", "2026-08-09", "2026-08-31", "2026-09-20"]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_are_counted_again_per_window(rows):
    total = run(rows, compare.month_over_month(), dims=())[("mom",)]
    groups = run(rows, compare.month_over_month())
    assert total.people == 3 and total.n == 4
    assert sum(r.n_change for r in groups.values()) == total.n_change
    assert sum(r.amount_change for r in groups.values()) == total.amount_change


def test_contribution_adds_up(rows):
    changes = compare.compare(rows, SET, "day", compare.extent(rows, "day"), [compare.month_over_month()], ["grp"])
    parts = compare.contribution(changes, "n", ["grp"]).collect()
    assert {r.total_change for r in parts} == {2}
    assert sum(r.share_of_change for r in parts) == pytest.approx(1.0)


def test_fixed_windows_and_labels(rows):
    windows = compare.fixed_windows("halves", (D("2026-08-01"), D("2026-09-30")), (D("2026-06-01"), D("2026-07-31")))
    placed = compare.in_windows(rows, "day", D("2026-09-20"), [windows]).collect()
    assert sorted((r.side, str(r.day)) for r in placed)[0] == ("current", "2026-08-02")
    assert {(r.comparison, r.current_period) for r in placed} == {("halves", "2026-08-01..2026-09-30")}
    with pytest.raises(ValueError):
        compare.fixed_windows("x", (D("2026-08-02"), D("2026-08-01")), (D("2026-06-01"), D("2026-07-31")))
    with pytest.raises(ValueError):
        compare.in_windows(rows, "day", D("2026-09-20"), [])


def test_rate_change_in_points_and_trend(spark):
    data = [(D("2026-08-01"), 1, 1)] * 3 + [(D("2026-08-01"), 0, 1)] + [(D("2026-07-01"), 1, 1), (D("2026-07-01"), 0, 1)]
    rows = spark.createDataFrame(data, "month date, num int, den int")
    rate = measures.rate("r", "num", "den")
    row = compare.compare(rows, rate, "month", compare.extent(rows, "month"), [compare.latest_months(1, "m", partial=True)]).first()
    assert (row.r_rate, row.r_rate_prior, row.r_rate_points) == (0.75, 0.5, 25.0)
    assert (row.r_num, row.r_den_prior) == (3, 2)
    assert [str(r.month) for r in compare.trend(rows, rate, "month").collect()] == ["2026-07-01", "2026-08-01"]


def test_trend_marks_the_partial_period(rows):
    months = rows.withColumn("month", F.trunc("day", "month"))
    found = compare.trend(months, SET[:1], "month", last=compare.extent(rows, "day")).collect()
    assert [(str(r.month), r.is_partial) for r in found][-2:] == [("2026-08-01", False), ("2026-09-01", True)]
    assert {str(r.data_until) for r in found} == {"2026-09-20"}


def test_parts_of_a_rate_change_add_up(spark):
    def group(name, month, num, den):
        return [(D(month), name, int(i < num), 1) for i in range(den)]

    data = (
        group("A", "2026-08-01", 6, 8) + group("A", "2026-07-01", 4, 4)
        + group("B", "2026-08-01", 1, 4) + group("B", "2026-07-01", 2, 4)
        + group("C", "2026-07-01", 1, 3) + group("D", "2026-08-01", 2, 2)
    )
    rows = spark.createDataFrame(data, "month date, grp string, num int, den int")
    rate = measures.rate("r", "num", "den")
    window = compare.latest_months(1, "m", partial=True)
    changes = compare.compare(rows, rate, "month", D("2026-08-31"), [window], ["grp"])
    parts = {r.grp: r for r in compare.rate_contribution(changes, "r", ["grp"]).collect()}
    assert sum(r.points for r in parts.values()) == pytest.approx((9 / 14 - 7 / 11) * 100, abs=1e-3)
    assert {r.total_points for r in parts.values()} == {round((9 / 14 - 7 / 11) * 100, 4)}
    # By hand: B's share of the rows fell from 4/11 to 4/14, its rate from 1/2 to 1/4.
    assert parts["B"].rate_points == pytest.approx((4 / 14 + 4 / 11) / 2 * -0.25 * 100, abs=1e-3)
    level = (9 / 14 + 7 / 11) / 2
    assert parts["B"].mix_points == pytest.approx((4 / 14 - 4 / 11) * (0.375 - level) * 100, abs=1e-3)
    assert parts["C"].rate_points == 0 and parts["D"].rate_points == 0
    ordered = [r.points for r in compare.rate_contribution(changes, "r", ["grp"]).collect()]
    assert ordered == sorted(ordered)


def test_extent(rows):
    row = compare.extent(rows, "day").first()
    assert [str(v) for v in row] == ["2025-08-31", "2026-09-20", "2026-09-01", "2026-08-01"]


def test_windows_of_every_last_date(spark):
    """All windows against plain date arithmetic, for each day of five years."""
    import calendar as cal

    def month(year, number):
        year, number = year + (number - 1) // 12, (number - 1) % 12 + 1
        return dt.date(year, number, 1)

    def end(first):
        return first.replace(day=cal.monthrange(first.year, first.month)[1])

    def expected(last):
        this = last.replace(day=1)
        done = this if last == end(this) else month(this.year, this.month - 1)
        before, year_before = month(done.year, done.month - 1), month(done.year - 1, done.month)
        start = month(done.year, done.month - (done.month - 4) % 12)
        same_days = dt.date(last.year - 1, last.month, min(last.day, end(month(last.year - 1, last.month)).day))
        half = month(done.year, done.month - 5)
        return [
            (done, end(done), before, end(before)),
            (done, end(done), year_before, end(year_before)),
            (this, last, month(last.year - 1, last.month), same_days),
            (start, end(done), month(start.year - 1, start.month), end(year_before)),
            (half, end(done), month(half.year, half.month - 6), half - dt.timedelta(days=1)),
        ]

    kinds = [
        compare.month_over_month(),
        compare.year_over_year(),
        compare.month_to_date(),
        compare.season(4),
        compare.latest_months(6, "half"),
    ]
    days = spark.sql("SELECT explode(sequence(DATE'2023-01-01', DATE'2027-12-31')) AS last")
    found = days.select("last", *[F.array(*kind.bounds(F.col("last"))) for kind in kinds]).collect()
    assert len(found) == 1826
    for row in found:
        assert [tuple(entry) for entry in row[1:]] == expected(row[0]), row[0]
