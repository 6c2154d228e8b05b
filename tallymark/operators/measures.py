"""Measures: defined once, recomputed from rows for every grouping and selection.

A measure holds no period. Rates divide summed numerators by summed denominators, and
distinct counts are counted again for each group; neither is ever put together from
smaller groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a measure is, which decides how a missing group and a change are shown.
ADDITIVE = "additive"  # counts and sums: zero without rows
DISTINCT = "distinct"  # zero without rows, but not the sum of its groups
AVERAGE = "average"  # unknown without rows
RATE = "rate"  # unknown without rows; its change is in percentage points

DIGITS = 6


@dataclass(frozen=True)
class Measure:
    """A name, a kind and the aggregate, built late because Columns need a session."""

    name: str
    kind: str
    build: Callable[[], Column]

    def column(self) -> Column:
        return self.build().alias(self.name)


def count_rows(name: str) -> Measure:
    return Measure(name, ADDITIVE, lambda: F.count("*"))


def count_flag(name: str, flag: str) -> Measure:
    return Measure(name, ADDITIVE, lambda: F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0).cast("long")))


def count_distinct(name: str, key: str, where: str | None = None) -> Measure:
    """Exact number of distinct keys, among the rows that pass the SQL condition ``where``.

    A condition is a FILTER clause and not a CASE around the key: distinct counts of one key
    then share one copy of the rows, and Spark shuffles fewer of them.
    """
    counted = f"count(DISTINCT `{key}`)"
    return Measure(name, DISTINCT, lambda: F.expr(f"{counted} FILTER (WHERE {where})" if where else counted))


def total(name: str, amount: str) -> Measure:
    return Measure(name, ADDITIVE, lambda: F.sum(amount).cast("decimal(38,2)"))


def average(name: str, value: str, where: str | None = None) -> Measure:
    """Mean of the known values among the rows that pass ``where``, NULL if there are none.

    The values are added as decimals, so the order of the rows cannot change the result.
    """

    def build() -> Column:
        known = F.col(value).cast("decimal(18,4)")
        kept = F.when(F.expr(where), known) if where else known
        return F.round(F.try_divide(F.sum(kept).cast("double"), F.count(kept)), DIGITS)

    return Measure(name, AVERAGE, build)


def rate(name: str, numerator: str, denominator: str) -> list[Measure]:
    """A rate with its two counts; NULL where the denominator is zero."""
    num, den = f"{name}_num", f"{name}_den"

    def build() -> Column:
        above = F.sum(F.col(numerator).cast("long")).cast("double")
        below = F.sum(F.col(denominator).cast("long")).cast("double")
        return F.round(F.try_divide(above, below), DIGITS)

    return [count_flag(num, numerator), count_flag(den, denominator), Measure(f"{name}_rate", RATE, build)]


# The dimensions that the two reporting tables offer.
CLINICAL_DIMENSIONS = (
    "clinic",
    "has_copd",
    "has_diabetes",
    "transportation_barrier",
    "housing_instability",
    "food_insecurity",
)
FINANCE_DIMENSIONS = (
    "discharge_date",
    "discharge_month",
    "fiscal_year",
    "fiscal_month",
    "facility",
    "service_line",
    "product",
    "patient_type",
    "financial_class_group",
)

CLINICAL: tuple[Measure, ...] = (
    *rate("screening", "screening_num", "screening_den"),
    *rate("cessation", "cessation_num", "cessation_den"),
    *rate("combined", "combined_num", "combined_den"),
    count_flag("care_gaps", "care_gap"),
)

FINANCE: tuple[Measure, ...] = (
    count_distinct("patients", "patient_id"),
    count_distinct("encounters", "primary_encounter_id"),
    count_distinct("surgical_cases", "primary_encounter_id", "surgical_case_flag"),
    average("case_mix_index", "ms_drg_weight", "patient_type = 'Inpatient'"),
    total("net_revenue", "estimated_net_revenue"),
    total("direct_cost", "total_direct_cost"),
    total("indirect_cost", "total_indirect_cost"),
    total("revenue_after_direct", "revenue_after_direct"),
)


def pick(measures: Iterable[Measure], *names: str) -> tuple[Measure, ...]:
    """Some measures of a set, by name."""
    known = {measure.name: measure for measure in measures}
    unknown = [name for name in names if name not in known]
    if unknown:
        raise ValueError(f"no measure named {', '.join(unknown)}")
    return tuple(known[name] for name in names)


def evaluate(
    rows: DataFrame,
    measures: Iterable[Measure],
    dims: Sequence[str | Column] = (),
    where: Column | None = None,
) -> DataFrame:
    """The measures of a selection for each combination of the dimensions (or overall)."""
    selected = rows if where is None else rows.where(where)
    return selected.groupBy(*dims).agg(*[measure.column() for measure in measures])


def evaluate_levels(
    rows: DataFrame, measures: Iterable[Measure], levels: Mapping[str, Sequence[str]], where: Column | None = None
) -> DataFrame:
    """The measures at several levels of grouping at once, from one pass over the rows.

    ``levels`` maps a level's name to its dimensions, none for the overall. Each row of the
    result has its ``level``; dimensions that the level does not have are NULL, and the level
    tells them from a NULL that is a group of its own. Distinct counts are counted for each
    level, not added up.
    """
    dims = list(dict.fromkeys(dim for level in levels.values() for dim in level))
    if not dims or len({frozenset(level) for level in levels.values()}) < len(levels):
        raise ValueError("levels need dimensions, and no two of them the same ones")
    selected = rows if where is None else rows.where(where)
    grouped = selected.groupingSets([[F.col(d) for d in level] for level in levels.values()], *[F.col(d) for d in dims])
    found = grouped.agg(F.grouping_id().alias("_level"), *[measure.column() for measure in measures])
    # Bit by bit from the first dimension on, 1 for one that the level does not have.
    numbers = {name: sum(1 << at for at, dim in enumerate(reversed(dims)) if dim not in level) for name, level in levels.items()}
    label = reduce(lambda chain, name: chain.when(F.col("_level") == numbers[name], name), numbers, F.when(F.lit(False), ""))
    return found.select(label.alias("level"), *dims, *[measure.name for measure in measures])


@dataclass(frozen=True)
class MeasureView:
    """A reporting table with its measures and the dimensions it is reported by."""

    rows: DataFrame
    measures: tuple[Measure, ...]
    dimensions: tuple[str, ...]

    def by(self, *dims: str, where: Column | None = None) -> DataFrame:
        """All measures of a selection, for each combination of some of the dimensions."""
        unknown = [dim for dim in dims if dim not in self.dimensions]
        if unknown:
            raise ValueError(f"no dimension named {', '.join(unknown)}")
        return evaluate(self.rows, self.measures, dims, where)


def clinical_view(patient_months: DataFrame, period: str = "reporting_month") -> MeasureView:
    return MeasureView(patient_months, CLINICAL, (period, *CLINICAL_DIMENSIONS))


def finance_view(accounts: DataFrame) -> MeasureView:
    return MeasureView(accounts, FINANCE, FINANCE_DIMENSIONS)
