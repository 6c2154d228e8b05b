"""Dates, ages and reporting periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column

ISO_DATE = "yyyy-MM-dd"


def parse_date(text: Column | str, pattern: str = ISO_DATE, strict: bool = True) -> Column:
    """Date from text. Bad text raises; with ``strict=False`` it gives NULL."""
    column = as_column(text)
    if strict:
        return F.to_date(column, pattern)
    return F.try_to_date(column, pattern)


def format_date(day: Column | str, pattern: str = ISO_DATE) -> Column:
    return F.date_format(as_column(day), pattern)


def reporting_month(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_column(day), "month")


def age_in_years(birth: Column | str, day: Column | str) -> Column:
    """Completed years at ``day``."""
    months = F.months_between(as_column(day), as_column(birth))
    return F.floor(months / F.lit(12)).cast("int")


def fiscal_year(day: Column | str, first_month: int = 10) -> Column:
    """Year named after the calendar year in which it ends (unless it starts in January)."""
    return F.year(_shift_to_fiscal(day, first_month))


def fiscal_month(day: Column | str, first_month: int = 10) -> Column:
    """1 for the first month of the fiscal year."""
    return F.month(_shift_to_fiscal(day, first_month))


def _shift_to_fiscal(day: Column | str, first_month: int) -> Column:
    if not 1 <= first_month <= 12:
        raise ValueError("first_month must be between 1 and 12")
    # The first of the month is shifted, so that no day is clipped at a month's end.
    return F.add_months(reporting_month(day), (13 - first_month) % 12)


def is_month_end(day: Column) -> Column:
    return day == F.last_day(day)


def latest_complete_month(last_day_of_data: Column) -> Column:
    """First day of the last month that the data covers to its end."""
    month = reporting_month(last_day_of_data)
    return F.when(is_month_end(last_day_of_data), month).otherwise(F.add_months(month, -1))


def reporting_week(day: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(as_column(day), "week")


def latest_complete_week(last_day_of_data: Column) -> Column:
    """Monday of the last week that the data covers to its Sunday."""
    return F.date_sub(reporting_week(F.date_add(last_day_of_data, 1)), 7)
