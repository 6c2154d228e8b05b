"""Search for the slices that account for a change: all levels of all dimensions at once.

A slice fixes the values of one or more dimensions. The rows of a comparison over all
dimensions together are few, and every slice is a sum of some of them. Slices are built
level by level; a slice can only hold a given share of the whole if each slice that it
narrows down does, so smaller ones are dropped before they are combined further.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.sources.staging import written

SIDES = ("current", "prior")
MOST_DIMS = 12  # a slice is numbered by the bits of its dimensions


def _value(dim: str) -> Column:
    return F.coalesce(F.col(dim).cast("string"), F.lit("\u0000"))


def _key(dims: Sequence[str], members: Sequence[int]) -> Column:
    """Text that tells slices of the same dimensions apart."""
    return F.concat_ws("\u0001", *[_value(dims[at]) for at in members]) if members else F.lit("")


def rate_slices(
    changes: DataFrame, name: str, dims: Sequence[str], min_share: float = 0.01, depth: int | None = None
) -> DataFrame:
    """Every slice with its part of a rate's change in percentage points, largest fall first.

    ``changes`` is the result of ``compare`` over all ``dims`` with the measures of
    ``rate(name, ...)``, for one comparison. A slice has at least ``min_share`` of the
    denominator of one of the two sides, and fixes at most ``depth`` dimensions; the others
    are NULL, and ``n_dims`` and ``fixed``, the names of those that are not, tell a fixed NULL
    from a free one. Parts are as in ``rate_contribution``: ``rate_points`` from the slice's
    own rate, ``mix_points`` from its weight, against all other rows. Slices overlap, so their
    parts do not add up; those of one set of dimensions do, if none of them is dropped.
    """
    if not 1 <= len(dims) <= MOST_DIMS:
        raise ValueError(f"give 1 to {MOST_DIMS} dimensions")
    names = {side: {part: f"{name}_{part}{'' if side == 'current' else '_prior'}" for part in ("num", "den")} for side in SIDES}
    sums = [column for side in SIDES for column in names[side].values()]
    base = written(changes.select(*dims, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums]), "slice-rows")
    whole = base.agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
    totals = {c: whole.select(f"_all_{c}").scalar() for c in sums}

    def share(side: str) -> Column:
        den = names[side]["den"]
        return F.coalesce(F.try_divide(F.col(den).cast("double"), totals[den].cast("double")), F.lit(0.0))

    kept: list[DataFrame] = []
    for size in range(1, (depth or len(dims)) + 1):
        groups = list(combinations(range(len(dims)), size))
        entry = F.array(*[
            F.struct(
                F.lit(sum(1 << at for at in group)).alias("mask"),
                _key(dims, group).alias("key"),
                # What the slice narrows down: all its dimensions but the last, and all but the first.
                *[
                    column
                    for nth, rest in enumerate((group[:-1], group[1:]))
                    for column in (F.lit(sum(1 << at for at in rest)).alias(f"wider_mask{nth}"), _key(dims, rest).alias(f"wider_key{nth}"))
                ],
                *[F.col(dims[at]).alias(dims[at]) if at in group else F.lit(None).cast(base.schema[dims[at]].dataType).alias(dims[at]) for at in range(len(dims))],
            )
            for group in groups
        ])
        rows = base.select(*sums, F.inline(entry))
        if size > 1:
            wider = kept[-1].select("mask", "key")
            for nth in range(2):
                rows = rows.join(wider.withColumnsRenamed({"mask": f"wider_mask{nth}", "key": f"wider_key{nth}"}), [f"wider_mask{nth}", f"wider_key{nth}"], "left_semi")
        summed = rows.groupBy("mask", "key").agg(*[F.sum(c).alias(c) for c in sums], *[F.max(d).alias(d) for d in dims])
        weighed = summed.withColumn("share", F.greatest(share("current"), share("prior")))
        kept.append(written(weighed.where(F.col("share") >= min_share), "slices"))

    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    weight = {side: share(side) for side in SIDES}
    own = {side: F.try_divide(F.col(names[side]["num"]).cast("double"), F.col(names[side]["den"]).cast("double")) for side in SIDES}
    overall = {side: F.try_divide(totals[names[side]["num"]].cast("double"), totals[names[side]["den"]].cast("double")) for side in SIDES}
    now = F.coalesce(own["current"], own["prior"], F.lit(0.0))
    then = F.coalesce(own["prior"], own["current"], F.lit(0.0))
    level = (overall["current"] + overall["prior"]) / 2
    by_rate = (weight["current"] + weight["prior"]) / 2 * (now - then) * 100.0
    by_mix = (weight["current"] - weight["prior"]) * ((now + then) / 2 - level) * 100.0
    fixed = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << at)) != 0, F.lit(d)) for at, d in enumerate(dims)]))
    return found.select(
        F.concat_ws(",", fixed).alias("fixed"), F.size(fixed).alias("n_dims"), *dims, *sums,
        F.round("share", 6).alias("share"),
        F.round(by_rate, 4).alias("rate_points"),
        F.round(by_mix, 4).alias("mix_points"),
        F.round(by_rate + by_mix, 4).alias("points"),
    ).orderBy("points", "fixed", *dims)
