"""Codes, labels, flags and money."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column


def map_values(code: Column | str, values: Mapping[Any, Any], otherwise: Any = None) -> Column:
    """Label or number of each code; other codes and NULL give ``otherwise``."""
    if not values:
        raise ValueError("map_values needs at least one entry")
    source = as_column(code)
    column = None
    for key, value in values.items():
        branch = source == F.lit(key)
        column = F.when(branch, F.lit(value)) if column is None else column.when(branch, F.lit(value))
    return column.otherwise(F.lit(otherwise))


def decode_flag(code: Column | str, yes: str = "Y") -> Column:
    """True for the yes code, false for any other code, NULL for NULL."""
    return as_column(code) == F.lit(yes)


def encode_flag(flag: Column | str, yes: str = "Y", no: str = "N") -> Column:
    return F.when(as_column(flag), F.lit(yes)).otherwise(F.lit(no))


CENTS = "decimal(20,2)"
RATE = "decimal(10,6)"


def money(amount: Column | str) -> Column:
    """An amount as a decimal of whole cents."""
    return as_column(amount).cast(CENTS)


def rate(share: Column | str) -> Column:
    """A rate as a decimal of six places: 0.125 stays 12.5 percent."""
    return as_column(share).cast(RATE)


def share_of(amount: Column, share: Column) -> Column:
    """``share`` (a decimal rate) of an amount of money, rounded to cents.

    Halves go away from zero, so a reversal is the exact opposite of its charge. Decimals
    all the way: no amount is too large to be exact.
    """
    return F.round(amount * share, 2).cast(CENTS)
