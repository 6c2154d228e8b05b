"""Quality checks: each gives a small result or the violating rows, as a DataFrame.

Only the ``require_`` functions run a job; they raise AssertionError.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.sources.staging import written


def duplicates(frame: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return frame.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child keys without a parent (``on`` maps child column -> parent column), with row counts.

    Both sides are reduced to one row per key before the join, so neither a child key nor
    a parent key with very many rows can fill a task. A child key with a NULL is an orphan.
    """
    child_keys = child.groupBy(*on).agg(F.count("*").alias("row_count"))
    parent_keys = parent.select(*[F.col(p).alias(f"_{c}") for c, p in on.items()]).distinct()
    same = reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in on])
    return child_keys.join(parent_keys, same, "left_anti")


def presence(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    marks: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Rows of each key in each of several tables: one scan per table and one shuffle in all.

    ``tables`` maps a name to a table and its key columns, which are matched by position
    and take the names that the first table gives them. ``marks`` maps a table's name to
    conditions whose rows are counted beside its own. Uniqueness and completeness of the
    tables are then conditions on a row of the result, so many checks cost no more than one.
    """
    names = list(next(iter(tables.values()))[1])
    conditions = {mark: (table, rule) for table, rules in (marks or {}).items() for mark, rule in rules.items()}
    tagged = [
        frame.select(
            *[F.col(key).alias(name) for key, name in zip(keys, names, strict=True)],
            *[F.lit(1 if other == table else 0).cast("long").alias(other) for other in tables],
            *[
                (F.when(rule, 1).otherwise(0) if owner == table else F.lit(0)).cast("long").alias(mark)
                for mark, (owner, rule) in conditions.items()
            ],
        )
        for table, (frame, keys) in tables.items()
    ]
    counted = [F.sum(name).alias(name) for name in (*tables, *conditions)]
    return reduce(DataFrame.union, tagged).groupBy(*names).agg(*counted)


def count_violations(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of rows that meet each condition, one line per condition, in one pass."""
    counts = frame.agg(*[F.count_if(rule).alias(f"_{at}") for at, rule in enumerate(rules.values())])
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(f"_{at}").alias("violations"))
            for at, name in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def key_profile(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows against distinct keys of several tables, one line each."""
    lines = [
        frame.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys")).select(
            F.lit(name).alias("source"), "rows", "distinct_keys"
        )
        for name, (frame, key) in sources.items()
    ]
    return reduce(DataFrame.union, lines)


def join_grain(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Rows after a left join to the detail, against distinct parent keys.

    Counted from the rows per key on each side: the joined rows themselves, which grow
    with the product of a hot key's counts, are never produced.
    """
    parents = parent.groupBy(F.col(parent_key).alias("_key")).agg(F.count("*").alias("_parents"))
    children = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_children"))
    matched = F.coalesce(F.col("_children"), F.lit(1))
    return parents.join(children, "_key", "left").agg(
        F.coalesce(F.sum(F.col("_parents") * matched), F.lit(0)).cast("long").alias("rows_after_join"),
        F.count("_key").alias("distinct_parents"),
        F.count(F.when(F.col("_children") > 1, True)).alias("parents_with_many"),
        F.count(F.when(F.col("_children").isNull(), True)).alias("parents_without"),
    )


def reconcile(
    sources: Mapping[str, tuple[DataFrame, Mapping[str, tuple[str, str]]]], gold: DataFrame
) -> DataFrame:
    """Row counts and amount totals of sources and of what was built from them.

    ``sources`` maps a name to a table and its amounts, label -> (source column, gold
    column). The gold rows are read once, for all sources together.
    """
    rows = F.count("*").cast("decimal(38,2)")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(38,2)")

    def lines(frame: DataFrame, side: str, entries: list[tuple[str, str, Column]]) -> DataFrame:
        sums = frame.agg(*[value.alias(f"_{at}") for at, (_, _, value) in enumerate(entries)])
        return sums.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(source).alias("source"),
                            F.lit(label).alias("total"),
                            F.lit(side).alias("_side"),
                            F.col(f"_{at}").alias("_value"),
                        )
                        for at, (source, label, _) in enumerate(entries)
                    ]
                )
            )
        )

    def entries(name: str, amounts: Mapping[str, tuple[str, str]], at: int):
        return [(name, "rows", rows), *[(name, label, total(pair[at])) for label, pair in amounts.items()]]

    parts = [lines(frame, "source", entries(name, amounts, 0)) for name, (frame, amounts) in sources.items()]
    built = [entry for name, (_, amounts) in sources.items() for entry in entries(name, amounts, 1)]
    parts.append(lines(gold, "gold", built))
    sides = [F.max(F.when(F.col("_side") == side, F.col("_value"))).alias(f"{side}_value") for side in ("source", "gold")]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("source", "total")
        .agg(*sides)
        .withColumn("difference", (F.col("source_value") - F.col("gold_value")).cast("decimal(38,2)"))
    )


def numerators_within(
    gold: DataFrame, pairs: Mapping[str, tuple[str, str]], dims: Sequence[str] = ()
) -> DataFrame:
    """Per group and rate: the two sums, the rows that break the rule, and whether it holds."""
    sums = gold.groupBy(*dims).agg(
        *[
            column
            for name, (num, den) in pairs.items()
            for column in (
                F.coalesce(F.sum(F.col(num).cast("long")), F.lit(0)).alias(f"_{name}_num"),
                F.coalesce(F.sum(F.col(den).cast("long")), F.lit(0)).alias(f"_{name}_den"),
                F.count_if(F.col(num) > F.col(den)).alias(f"_{name}_bad"),
            )
        ]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("measure"),
                F.col(f"_{name}_num").alias("numerator"),
                F.col(f"_{name}_den").alias("denominator"),
                F.col(f"_{name}_bad").alias("violating_rows"),
            )
            for name in pairs
        ]
    )
    return sums.select(*dims, F.inline(lines)).withColumn(
        "holds", (F.col("violating_rows") == 0) & (F.col("numerator") <= F.col("denominator"))
    )


def expected_trend(
    rows: DataFrame, day: str, current_year: int | Column, months: tuple[int, int], segment: Column | None = None
) -> DataFrame:
    """Rows of one segment and season in two successive years, and whether they fell."""
    year = current_year if isinstance(current_year, Column) else F.lit(current_year)
    first, last = months
    chosen = rows if segment is None else rows.where(segment)
    inside = chosen.where(
        (F.col(day) >= F.make_date(year - 1, F.lit(first), F.lit(1)))
        & (F.col(day) <= F.last_day(F.make_date(year, F.lit(last), F.lit(1))))
        & F.month(day).between(first, last)
    )

    def in_year(wanted: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.year(day) == wanted, 1).otherwise(0)), F.lit(0)).cast("long")

    return inside.agg(in_year(year - 1).alias("prior_year"), in_year(year).alias("current_year")).withColumn(
        "fell", (F.col("prior_year") > 0) & (F.col("current_year") < F.col("prior_year"))
    )


def agreement(judged: DataFrame, expected: str, predicted: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts of a yes/no label against what is expected, with precision and recall.

    A row without either counts as ``undecided`` and in nothing else. ``weight`` names a
    column that says how often each row counts.
    """
    says, is_so = F.col(predicted), F.col(expected)
    times = F.lit(1) if weight is None else F.col(weight)

    def count(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, times)), F.lit(0)).cast("long").alias(name)

    counts = judged.groupBy(*by).agg(
        count(is_so & says, "true_positive"),
        count(~is_so & says, "false_positive"),
        count(is_so & ~says, "false_negative"),
        count(~is_so & ~says, "true_negative"),
        count(is_so.isNull() | says.isNull(), "undecided"),
    )
    right = F.col("true_positive").cast("double")
    return counts.withColumns(
        {
            "precision": F.round(F.try_divide(right, F.col("true_positive") + F.col("false_positive")), 6),
            "recall": F.round(F.try_divide(right, F.col("true_positive") + F.col("false_negative")), 6),
        }
    )


def disagreements(judged: DataFrame, expected: str, predicted: str) -> DataFrame:
    """The rows whose label is not what is expected; a missing label agrees with nothing."""
    return judged.where(~F.coalesce(F.col(expected) == F.col(predicted), F.lit(False)))


def require_known(judged: DataFrame, expected: str, predicted: str) -> None:
    """Raise unless every known text is labelled as expected."""
    require_empty(disagreements(judged, expected, predicted), "known texts are not labelled as expected")


def _bucket_sums(frame: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int, side: str) -> DataFrame:
    """Rows and an order-independent checksum of each bucket of keys."""
    row = F.xxhash64(*keys, *columns)
    # Two sums, so that rows which differ and cancel in one of them do not in the other.
    return frame.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")).agg(
        F.struct(
            F.count("*").alias("rows"),
            F.sum(row.cast("decimal(38,0)")).alias("total"),
            F.bit_xor(F.xxhash64(row, F.lit(1))).alias("mixed"),
        ).alias(side)
    )


def reconcile_rows(
    source: DataFrame, gold: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 1 << 16
) -> DataFrame:
    """The keys that differ between a source and what was built from it.

    Both sides are first compared by checksums of buckets of keys, one small row each; only
    rows of buckets that differ are then brought together by key. ``keys`` and ``columns``
    are named and typed alike on both sides. The result has the keys, the rows of each side,
    and ``differs``: the columns whose values are not the same (for keys with rows on both
    sides; repeated rows are compared by their smallest and largest values).
    """
    if buckets < 1 or not keys:
        raise ValueError("give at least one key and one bucket")
    sums = _bucket_sums(source, keys, columns, buckets, "_a").join(
        _bucket_sums(gold, keys, columns, buckets, "_b"), "bucket", "full"
    )
    # At most ``buckets`` rows; written, so that their real number decides how they are joined.
    unequal = written(sums.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("bucket"), "unequal-buckets")
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets))

    def side(frame: DataFrame, name: str) -> DataFrame:
        kept = frame.select(*keys, *columns, number.alias("bucket")).join(unequal, "bucket", "left_semi")
        ends = [F.struct(F.min(c).alias("least"), F.max(c).alias("most")).alias(f"_{c}") for c in columns]
        return kept.groupBy(*keys).agg(F.count("*").alias("rows"), *ends).withColumn("_side", F.lit(name))

    both = side(source, "source").unionByName(side(gold, "gold"))

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == name, F.col(column)))

    beside = both.groupBy(*keys).agg(
        F.coalesce(of("source", "rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(of("gold", "rows"), F.lit(0)).alias("gold_rows"),
        F.array_compact(
            F.array(*[F.when(~of("source", f"_{c}").eqNullSafe(of("gold", f"_{c}")), F.lit(c)) for c in columns])
            if columns else F.array().cast("array<string>")
        ).alias("differs"),
    )
    nothing = F.array().cast("array<string>")
    in_both = (F.col("source_rows") > 0) & (F.col("gold_rows") > 0)
    return beside.withColumn("differs", F.when(in_both, F.col("differs")).otherwise(nothing)).where(
        (F.col("source_rows") != F.col("gold_rows")) | (F.size("differs") > 0)
    )


def profile(frame: DataFrame, by: str, *columns: Column, order: str) -> DataFrame:
    """Distribution of a category, largest first; ties in the order of the category."""
    return frame.groupBy(by).agg(*columns).orderBy(F.desc(order), F.asc(by))


def require_empty(violations: DataFrame, message: str) -> None:
    if not violations.isEmpty():
        raise AssertionError(message)


def require_all(result: DataFrame, flag: str, message: str) -> None:
    if not result.where(~F.coalesce(F.col(flag), F.lit(False))).isEmpty():
        raise AssertionError(message)
