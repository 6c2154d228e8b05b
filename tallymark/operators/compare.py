"""Honest period comparisons of any measures.

A comparison is a pair of date windows, computed from the last date of the data. Given as
a literal, that date makes the windows constants, and the date range reaches the scan as a
filter; given as a one-row frame, it becomes a scalar subquery over the date column. A row
is copied into each window it falls in (there is no join), the measures are computed per
window, and the two sides of a comparison are put side by side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.calendar import latest_complete_month, latest_complete_week, reporting_month
from tallymark.operators.measures import ADDITIVE, DIGITS, DISTINCT, RATE, Measure, evaluate
from tallymark.sources.staging import written

LABELS = ("comparison", "current_period", "prior_period", "data_until")


@dataclass(frozen=True)
class Comparison:
    """A named pair of inclusive date windows, given the last date of the data."""

    name: str
    bounds: Callable[[Column], tuple[Column, Column, Column, Column]]


def _year_before(month: Column) -> Column:
    return F.add_months(month, -12)


def month_over_month(name: str = "mom") -> Comparison:
    """The latest complete month and the month before it."""

    def bounds(last: Column):
        month = latest_complete_month(last)
        before = F.add_months(month, -1)
        return month, F.last_day(month), before, F.last_day(before)

    return Comparison(name, bounds)


def year_over_year(name: str = "yoy") -> Comparison:
    """The latest complete month and the same month a year earlier."""

    def bounds(last: Column):
        month = latest_complete_month(last)
        before = _year_before(month)
        return month, F.last_day(month), before, F.last_day(before)

    return Comparison(name, bounds)


def month_to_date(name: str = "mtd") -> Comparison:
    """The last month up to the last date, and the same days a year earlier."""

    def bounds(last: Column):
        month = reporting_month(last)
        return month, last, _year_before(month), _year_before(last)

    return Comparison(name, bounds)


def season(first_month: int, name: str = "season") -> Comparison:
    """From a calendar month to the latest complete month, and the same months a year earlier."""
    if not 1 <= first_month <= 12:
        raise ValueError("first_month must be between 1 and 12")

    def bounds(last: Column):
        end = latest_complete_month(last)
        back = F.pmod(F.month(end) - F.lit(first_month), F.lit(12))
        start = F.add_months(end, -back)
        return start, F.last_day(end), _year_before(start), F.last_day(_year_before(end))

    return Comparison(name, bounds)


def latest_months(months: int, name: str, partial: bool = False) -> Comparison:
    """The last ``months`` months, and as many months before them.

    They end with the latest complete month; with ``partial``, with the last month that
    occurs, even if the data covers a part of it only.
    """
    if months < 1:
        raise ValueError("months must be positive")

    def bounds(last: Column):
        end = reporting_month(last) if partial else latest_complete_month(last)
        start = F.add_months(end, 1 - months)
        before = F.add_months(start, -months)
        return start, F.last_day(end), before, F.date_sub(start, 1)

    return Comparison(name, bounds)


def latest_weeks(weeks: int, name: str) -> Comparison:
    """The last ``weeks`` complete weeks (Monday to Sunday), and as many weeks before them."""
    if weeks < 1:
        raise ValueError("weeks must be positive")

    def bounds(last: Column):
        end = latest_complete_week(last)
        start = F.date_sub(end, 7 * (weeks - 1))
        return start, F.date_add(end, 6), F.date_sub(start, 7 * weeks), F.date_sub(start, 1)

    return Comparison(name, bounds)


def fixed_windows(
    name: str, current: tuple[dt.date, dt.date], prior: tuple[dt.date, dt.date]
) -> Comparison:
    """Two windows given by their first and last dates."""
    for start, end in (current, prior):
        if start > end:
            raise ValueError("a window must not end before it starts")
    dates = (*current, *prior)
    return Comparison(name, lambda last: tuple(F.lit(day) for day in dates))


def extent(rows: DataFrame, day: str) -> DataFrame:
    """First and last date, the month of the last date, and the latest complete month."""
    last = F.max(day)
    return rows.agg(F.min(day).alias("first_date"), last.alias("last_date")).select(
        "first_date",
        "last_date",
        reporting_month("last_date").alias("last_month"),
        latest_complete_month(F.col("last_date")).alias("latest_complete_month"),
    )


def last_date(rows: DataFrame, day: str) -> dt.date:
    """The last date of the data, read by a job of its own, as a literal for the windows.

    Only this one value reaches the driver. Without rows it is the first of January 1970.
    """
    return rows.agg(F.max(day)).first()[0] or dt.date(1970, 1, 1)


def _span(first: Column, final: Column) -> Column:
    return F.concat_ws("..", first.cast("string"), final.cast("string"))


def _layout(last: Column, comparisons: Sequence[Comparison]) -> dict[str, Column]:
    """Everything the windows decide: overall range, bounds in pairs, labels per comparison.

    Window 2k is the current side of comparison k, window 2k + 1 its prior side.
    """
    edges = [(item.name, *item.bounds(last)) for item in comparisons]
    pairs = [pair for _, a, b, c, d in edges for pair in ((a, b), (c, d))]
    return {
        "earliest": F.least(*[start for start, _ in pairs]),
        "latest": F.greatest(*[end for _, end in pairs]),
        "bounds": F.array(*[F.struct(start.alias("start"), end.alias("end")) for start, end in pairs]),
        "labels": F.array(
            *[
                F.struct(
                    F.lit(name).alias("comparison"),
                    _span(a, b).alias("current_period"),
                    _span(c, d).alias("prior_period"),
                    last.cast("string").alias("data_until"),
                )
                for name, a, b, c, d in edges
            ]
        ),
    }


def _wanted(comparisons: Iterable[Comparison]) -> list[Comparison]:
    wanted = list(comparisons)
    if not wanted:
        raise ValueError("give at least one comparison")
    return wanted


def _resolve(last: DataFrame | dt.date, comparisons: Iterable[Comparison]) -> dict[str, Column]:
    wanted = _wanted(comparisons)
    if isinstance(last, dt.date):
        return _layout(F.lit(last), wanted)
    # The windows are worked out on the one-row side, once for the whole query.
    layout = _layout(F.col("last_date"), wanted)
    single = last.select(*[column.alias(name) for name, column in layout.items()])
    return {name: single.select(name).scalar() for name in layout}


def in_any_window(
    column: Column, last: DataFrame | dt.date, comparisons: Iterable[Comparison], dtype: str = "date"
) -> Column:
    """Condition that a column of type ``dtype`` lies in a window that is needed.

    For use on a source's own column, before its joins. Given a literal last date, the scan
    gets a range for each window, so the gaps between the windows are not read either; with
    a frame the bounds are subqueries, which Spark joins into one and keeps out of the scan.
    """
    wanted = _wanted(comparisons)

    def bound(build: Callable[[Column], Column]) -> Column:
        if isinstance(last, dt.date):
            return build(F.lit(last)).cast(dtype)
        return last.agg(F.min(build(F.col("last_date"))).cast(dtype)).scalar()

    ranges = [
        (column >= bound(lambda day, at=at, item=item: item.bounds(day)[at]))
        # The day after the end, as the column may hold a time of the day.
        & (column < bound(lambda day, at=at, item=item: F.date_add(item.bounds(day)[at + 1], 1)))
        for item in wanted
        for at in (0, 2)
    ]
    return reduce(Column.__or__, ranges)


def _place(rows: DataFrame, day: str, layout: dict[str, Column]) -> DataFrame:
    """Each row once per window that holds its date, with the window's number only.

    The overall range is filtered first, on the bare date column, so that it can reach
    the scan. The labels stay behind, to keep the rows narrow in the shuffles to come.
    """
    numbered = rows.where((F.col(day) >= layout["earliest"]) & (F.col(day) <= layout["latest"])).select(
        "*", F.posexplode(layout["bounds"]).alias("_window", "_bounds")
    )
    return numbered.where(F.col(day).between(F.col("_bounds.start"), F.col("_bounds.end"))).drop("_bounds")


def _label(layout: dict[str, Column], comparison: Column) -> list[Column]:
    entry = F.element_at(layout["labels"], comparison + F.lit(1))
    return [entry.getField(name).alias(name) for name in LABELS]


def in_windows(
    rows: DataFrame, day: str, last: DataFrame | dt.date, comparisons: Iterable[Comparison]
) -> DataFrame:
    """Each row once per window that holds its date, with the comparison, side and periods.

    ``last`` is the last date of the data, or a one-row frame with a ``last_date`` column
    such as ``extent`` gives.
    """
    layout = _resolve(last, comparisons)
    window = F.col("_window")
    side = F.when(window % 2 == 0, F.lit("current")).otherwise(F.lit("prior"))
    return _place(rows, day, layout).select(
        *_label(layout, F.floor(window / 2).cast("int")), side.alias("side"), *rows.columns
    )


def compare(
    rows: DataFrame,
    measures: Iterable[Measure],
    day: str,
    last: DataFrame | dt.date,
    comparisons: Iterable[Comparison],
    dims: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Current value, prior value and change of each measure, per comparison and group.

    A group found on one side only is kept: its counts and sums are zero on the other
    side, its rates and averages unknown. ``last`` is as for ``in_windows``.
    """
    chosen = list(measures)
    layout = _resolve(last, comparisons)
    selected = rows if where is None else rows.where(where)
    sides = evaluate(_place(selected, day, layout), chosen, ["_window", *dims])
    numbered = sides.withColumns(
        {"_comparison": F.floor(F.col("_window") / 2).cast("int"), "_side": F.col("_window") % 2}
    )
    beside = numbered.groupBy("_comparison", *dims).agg(
        *[
            F.max(F.when(F.col("_side") == at, F.col(measure.name))).alias(f"{measure.name}_{side}")
            for measure in chosen
            for at, side in enumerate(("current", "prior"))
        ]
    )
    changes = [column for measure in chosen for column in _change_columns(measure)]
    return beside.select(*_label(layout, F.col("_comparison")), *dims, *changes)


def _change_columns(measure: Measure) -> list[Column]:
    name = measure.name
    now, then = F.col(f"{name}_current"), F.col(f"{name}_prior")
    if measure.kind in (ADDITIVE, DISTINCT):
        now, then = F.coalesce(now, F.lit(0)), F.coalesce(then, F.lit(0))
    shown = [now.alias(name), then.alias(f"{name}_prior")]
    if measure.kind == RATE:
        points = F.round((now - then) * F.lit(100.0), 4)
        return [*shown, points.alias(f"{name}_points")]
    change = now - then
    if measure.kind not in (ADDITIVE, DISTINCT):
        change = F.round(change, DIGITS)
    percent = F.try_divide(change.cast("double") * F.lit(100.0), then.cast("double"))
    return [
        *shown,
        change.alias(f"{name}_change"),
        F.round(percent, 4).alias(f"{name}_percent"),
    ]


def contribution(changes: DataFrame, measure: str, dims: Sequence[str]) -> DataFrame:
    """Each group's part of the overall change of one additive measure, largest fall first.

    The parts say where a change was recorded, not what caused it. ``changes`` is the
    result of ``compare`` over ``dims``.
    """
    change = F.col(f"{measure}_change")
    totals = changes.groupBy("comparison").agg(F.sum(change).alias("total_change"))
    joined = changes.join(totals, "comparison")
    share = F.try_divide(change.cast("double"), F.col("total_change").cast("double"))
    return joined.select(
        *LABELS,
        *dims,
        measure,
        f"{measure}_prior",
        f"{measure}_change",
        "total_change",
        F.round(share, DIGITS).alias("share_of_change"),
    ).orderBy("comparison", f"{measure}_change", *dims)


def rate_contribution(changes: DataFrame, name: str, dims: Sequence[str]) -> DataFrame:
    """Each group's part of the change of a rate, in percentage points, largest fall first.

    With w a group's share of the denominator and r its rate, the overall rate is the sum
    of w r. Its change is the sum over the groups of a rate part, the mean w times the
    change of r, and a mix part, the change of w times the mean r less the overall rate's
    mean: a group adds by its mix if it grew and its rate is above the others'. A group
    without a denominator on one side has no rate there; its rate on the other side is
    taken for both, so all of its part is mix. ``changes`` is the result of ``compare``
    over ``dims`` with the measures of ``rate(name, ...)``.
    """
    sides = {"current": "", "prior": "_prior"}
    totals = changes.groupBy("comparison").agg(
        *[
            F.sum(F.col(f"{name}_{part}{suffix}").cast("double")).alias(f"_{part}_{side}")
            for side, suffix in sides.items()
            for part in ("num", "den")
        ]
    )
    joined = changes.join(totals, "comparison")
    weight, own, overall = {}, {}, {}
    for side, suffix in sides.items():
        num, den = (F.col(f"{name}_{part}{suffix}").cast("double") for part in ("num", "den"))
        weight[side] = F.coalesce(F.try_divide(den, F.col(f"_den_{side}")), F.lit(0.0))
        own[side] = F.try_divide(num, den)
        overall[side] = F.try_divide(F.col(f"_num_{side}"), F.col(f"_den_{side}"))
    now = F.coalesce(own["current"], own["prior"], F.lit(0.0))
    then = F.coalesce(own["prior"], own["current"], F.lit(0.0))
    level = (overall["current"] + overall["prior"]) / 2
    rate_part = (weight["current"] + weight["prior"]) / 2 * (now - then)
    mix_part = (weight["current"] - weight["prior"]) * ((now + then) / 2 - level)
    points = F.round((rate_part + mix_part) * 100.0, 4)
    return joined.select(
        *LABELS,
        *dims,
        *[F.col(f"{name}_{part}{suffix}") for suffix in sides.values() for part in ("num", "den")],
        F.round(rate_part * 100.0, 4).alias("rate_points"),
        F.round(mix_part * 100.0, 4).alias("mix_points"),
        points.alias("points"),
        F.round((overall["current"] - overall["prior"]) * 100.0, 4).alias("total_points"),
    ).orderBy("comparison", "points", *dims)


def trend(
    rows: DataFrame,
    measures: Iterable[Measure],
    month: str,
    dims: Sequence[str] = (),
    where: Column | None = None,
    last: DataFrame | None = None,
    period_end: Callable[[Column], Column] = F.last_day,
) -> DataFrame:
    """The measures period by period, in order.

    With ``last`` (see ``extent``) each period is marked: ``data_until`` is the last date
    of the data, and ``is_partial`` tells that the period goes on after it.
    """
    found = evaluate(rows, measures, [month, *dims], where)
    if last is not None:
        until = last.select("last_date").scalar()
        found = found.withColumns({"data_until": until, "is_partial": period_end(F.col(month)) > until})
    return found.orderBy(month, *dims)


def dense_trend(
    rows: DataFrame,
    measures: Iterable[Measure],
    period: str,
    dims: Sequence[str] = (),
    step: str = "1 month",
    where: Column | None = None,
) -> DataFrame:
    """The measures of every group in every period from the first to the last, with changes.

    A period in which a group has no rows is shown: ``has_rows`` is false, its counts and sums
    are zero, its averages and rates unknown. Beside each measure stand its value one period
    before and its change, in points for a rate; both are NULL in the first period. The groups
    and the periods are those that occur in the selection; ``step`` is the SQL interval
    between periods. A NULL period is left out; a NULL in a dimension is a group.
    """
    chosen = list(measures)
    selected = rows if where is None else rows.where(where)
    # A row for each group and period: small, used three times below, so written once.
    found = written(evaluate(selected.where(F.col(period).isNotNull()), chosen, [period, *dims]), "periods")
    ends = found.agg(F.min(period).alias("first"), F.max(period).alias("last"))
    calendar = F.sequence(ends.select("first").scalar(), ends.select("last").scalar(), F.expr(f"INTERVAL {step}"))
    groups = found.select(*dims).distinct() if dims else found.select(F.lit(True)).limit(1)
    every = groups.select(*dims, F.explode(calendar).alias(period))
    known = found.withColumnsRenamed({name: f"_{name}" for name in (period, *dims)}).withColumn("has_rows", F.lit(True))
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in (period, *dims)])
    dense = every.join(known, same, "left")
    counts = (ADDITIVE, DISTINCT)
    filled = dense.select(
        period, *dims, F.coalesce("has_rows", F.lit(False)).alias("has_rows"),
        *[(F.coalesce(m.name, F.lit(0)) if m.kind in counts else F.col(m.name)).alias(m.name) for m in chosen],
    )
    along = Window.partitionBy(*dims).orderBy(period)

    def change(measure: Measure) -> Column:
        apart = F.col(measure.name) - F.col(f"{measure.name}_before")
        if measure.kind == RATE:
            return F.round(apart * F.lit(100.0), 4).alias(f"{measure.name}_points")
        return (apart if measure.kind in counts else F.round(apart, DIGITS)).alias(f"{measure.name}_change")

    lagged = filled.withColumns({f"{m.name}_before": F.lag(m.name).over(along) for m in chosen})
    beside = [column for m in chosen for column in (F.col(m.name), F.col(f"{m.name}_before"), change(m))]
    return lagged.select(period, *dims, "has_rows", *beside).orderBy(period, *dims)
