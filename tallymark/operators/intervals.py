"""Rows in windows that are given as a table: any number of them, of any length, overlapping.

An interval join by time bins. A window belongs to the level whose bins are as long as the
next power of two of its days, so it meets two bins at most; a row has one bin at each level
in use. Rows and windows are joined on level and bin, and their dates compared within: an
equality join, whatever the number of windows, that gives each row once per window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bin(day: Column, level: Column) -> Column:
    return F.call_function("shiftright", F.unix_date(day), level)


def binned(windows: DataFrame, first: str, last: str) -> DataFrame:
    """The windows with ``_level`` and a row for each ``_bin`` they meet, one or two. Windows
    without a first or last day, or that end before they begin, hold no row and are dropped."""
    real = windows.where(F.col(last) >= F.col(first))
    level = F.ceil(F.log2((F.datediff(last, first) + 1).cast("double"))).cast("int")
    placed = real.withColumn("_level", level)
    ends = [_bin(F.col(name), F.col("_level")) for name in (first, last)]
    return placed.withColumn("_bin", F.explode(F.sequence(*ends)))


def in_window_table(rows: DataFrame, day: str, windows: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Each row once for every window that holds its date, with the window's columns.

    ``day`` is a date, ``first`` and ``last`` are inclusive dates of ``windows``; the columns of
    both must be named apart. The range of all windows and the levels in use, at most 32, are
    read by a job of their own: the range is a literal filter that reaches the scan. A row
    without a date is in no window.
    """
    placed = binned(windows, first, last)
    earliest, latest, levels = placed.agg(F.min(first), F.max(last), F.sort_array(F.collect_set("_level"))).first()
    used = F.array(*[F.lit(level) for level in levels]) if levels else F.array().cast("array<int>")
    # With no window, the range below holds no row.
    inside = F.col(day).between(F.lit(earliest or dt.date(1970, 1, 2)), F.lit(latest or dt.date(1970, 1, 1)))
    leveled = rows.where(inside).select("*", F.explode(used).alias("_level"))
    met = leveled.withColumn("_bin", _bin(F.col(day), F.col("_level"))).join(placed, ["_level", "_bin"])
    return met.where(F.col(day).between(F.col(first), F.col(last))).drop("_level", "_bin")
