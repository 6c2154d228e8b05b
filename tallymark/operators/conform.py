"""Source-shaped frames to typed tables, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame


def conform(frame: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Exactly the named columns, in order: one projection that renames, casts and decodes."""
    return frame.select(*[column.alias(name) for name, column in columns.items()])


def split(frame: DataFrame, entities: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
    """Several narrow tables from one wide base, each a mapping of new name -> base column."""
    known = set(frame.columns)
    missing = {source for names in entities.values() for source in names.values()} - known
    if missing:
        raise ValueError(f"the base has no column {', '.join(sorted(missing))}")
    return {
        entity: conform(frame, {name: frame[source] for name, source in names.items()})
        for entity, names in entities.items()
    }


def preview(frame: DataFrame, columns: Sequence[str], order: Sequence[Column | str], rows: int) -> DataFrame:
    """The first rows of some columns in an order that the caller makes unique."""
    return frame.select(*columns).orderBy(*order).limit(rows)
