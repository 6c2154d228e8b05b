"""Exact distinct counts for any selection, put together from smaller groups.

Distinct counts are not the sum of their groups. A bitmap of the keys of each smallest group
can be merged, so it is made once, in one pass over the rows, and every larger group is read
from the bitmaps alone. Keys are whole numbers; ``number_keys`` gives dense ones to others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096


def number_keys(frame: DataFrame, key: str, number: str = "number") -> DataFrame:
    """``key, number``: the different keys, numbered from 0 without gaps. NULL is no key.

    Numbers go by cells of the key's hash: the cells are added up first (``CELLS`` rows), then
    each cell's keys are ordered by themselves. The same keys get the same numbers.
    """
    keys = frame.select(key).where(F.col(key).isNotNull()).distinct()
    celled = keys.withColumn("_cell", F.pmod(F.xxhash64(key), F.lit(CELLS)))
    sizes = celled.groupBy("_cell").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cell", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_cell").orderBy(key)) - 1
    return celled.withColumn("_nth", nth).join(offsets, "_cell").select(key, (F.col("_before") + F.col("_nth")).alias(number))


def bitmaps(frame: DataFrame, dims: Sequence[str], counts: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """``dims, measure, bucket, bits``: the keys of each smallest group, as bitmaps.

    ``counts`` maps a measure to its key column and the SQL condition that a row must pass
    (or None). One row for each 32,768 numbers in use of a group and measure; the bitmaps
    are built before the shuffle. Rows whose key is NULL are left out.
    """
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("measure"),
            (F.when(F.expr(where), F.col(key)) if where else F.col(key)).cast("long").alias("key"),
        )
        for name, (key, where) in counts.items()
    ])
    keyed = frame.select(*dims, F.inline(entries)).where("key is not null")
    return keyed.groupBy(*dims, "measure", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")
    )


def merged(made: DataFrame, dims: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """The distinct counts for some of the dimensions (or overall), from the bitmaps."""
    united = made.groupBy(*dims, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = united.groupBy(*dims, "measure").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return sizes.groupBy(*dims).agg(
        *[F.coalesce(F.sum(F.when(F.col("measure") == name, F.col("n"))), F.lit(0)).alias(name) for name in counts]
    )
