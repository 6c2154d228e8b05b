"""Rows derived from keyed tables by deterministic rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.draws import uniform


def month_panel(
    entities: DataFrame,
    first_month: dt.date,
    months: int,
    index: str = "month_index",
    month: str = "reporting_month",
) -> DataFrame:
    """Each entity once per month of a short calendar.

    The calendar is unfolded inside each row, so the panel needs neither a join nor a
    shuffle, and a filter that follows runs in the same stage.
    """
    if months < 1:
        raise ValueError("a calendar has one month at least")
    numbered = entities.select("*", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias(index))
    return numbered.withColumn(month, F.add_months(F.lit(first_month), F.col(index)))


def keyed_sample(
    frame: DataFrame, salt: str, keys: Sequence[str | Column], share: float, **draw_options
) -> DataFrame:
    """Rows whose keyed draw lies below ``share``; the same rows on every run."""
    if not 0 <= share <= 1:
        raise ValueError("share must lie in [0, 1]")
    return frame.where(uniform(salt, *keys, **draw_options) < F.lit(float(share)))


def outside(frame: DataFrame, segment: Column) -> DataFrame:
    """Rows that are known not to be in a segment. Undecided rows are dropped too."""
    return frame.where(~segment)


def as_of(frame: DataFrame, day: str, cutoff: dt.date) -> DataFrame:
    """Rows up to and including a cutoff date."""
    return frame.where(F.col(day) <= F.lit(cutoff))
