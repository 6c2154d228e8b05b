"""Joins that keep the grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def join_dimension(
    facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Facts with the columns of a dimension that has one row per key.

    One join at every size: adaptive execution broadcasts a dimension that proves small
    when the query runs, and splits a hot key's facts where both sides are shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_dimension knows the join types 'inner' and 'left'")
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(dimension, keys, how)


def collapse(detail: DataFrame, keys: str | Sequence[str], *aggregates: Column) -> DataFrame:
    """Detail rows brought to one row per parent key, ready for a 1:1 join.

    Give aggregates that can be merged (counts, sums, minima, flags): they are combined
    before the shuffle, so a parent with a third of all detail rows stays small.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    return detail.groupBy(*names).agg(*aggregates)


def only_of(detail: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The detail rows of some parents, cut before they are collapsed.

    A semi-join on the parents' keys: few parents are broadcast, and the detail is then
    filtered where it is read, without a shuffle.
    """
    return detail.join(parents.select(key).distinct(), key, "left_semi")
