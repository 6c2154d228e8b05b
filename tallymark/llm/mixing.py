"""Sources mixed to target weights by capped water-filling, in built-in functions only.

Every source is clamped at a maximum number of epochs; what it cannot take goes to the
others in proportion to their weights, until none is above its cap. A document is then
taken as often as its source's whole epochs, and the fractional epoch goes down the
source's documents in the order of a seeded hash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import written
from tallymark.llm.texts import text_or_empty, word_count

CELL_DIGITS = 3  # hexadecimal digits of the hash that name one of a source's 4,096 cells
EXACT = "decimal(38,0)"


def targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Adds ``target`` (double) to ``source, source_size``; one row for each source.

    Sources in code point order, null last, take the weights in turn and share the sum of
    all sizes. All of this works on the table of sources, whose rows are few; only there
    does an order over all rows matter.
    """
    ranked = sources.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int")))
    everything = Window.partitionBy()
    # By rising cap per unit of weight, capped sources come first. Exact in whole numbers.
    scale = math.lcm(*weights)
    cap = F.col("source_size").cast(EXACT) * max_epochs
    rising = Window.orderBy("cap_per_weight", "rank")
    level = (
        ranked.withColumn("cap", cap.cast(EXACT))
        .withColumn("cap_per_weight", (F.col("cap") * F.expr(f"{scale} div weight")).cast(EXACT))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn(
            "caps_before",
            F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("weights_from", F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "capped",
            F.col("cap") * F.col("weights_from") <= F.col("weight") * (F.col("total") - F.col("caps_before")),
        )
        .withColumn("taken_by_capped", F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything))
        .withColumn("open_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything))
    )
    left = F.col("total") - F.coalesce(F.col("taken_by_capped"), F.lit(0))
    share = (F.col("weight") * left).cast("double") / F.col("open_weight").cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix"
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``.

    ``size`` counts the text's words, none for a null or empty text. ``taken`` is the number
    of words the mix takes: ``size`` times the source's whole epochs, and one more time for
    the documents that come first by hash, up to the fractional epoch. The one document
    that this boundary cuts gives its first words only, so that a source gives exactly its
    target, rounded to whole words. A null source is a source; ties of the hash (repeated
    rows, or a repeated ``doc_id``) are ordered by size; rows that are equal in both can stand for
    each other. Other columns are not read. No rows give no rows.
    """
    # Rows without an id are told apart by their texts, so that they do not share one place.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(text_or_empty("text"))))
    order_key = F.md5(F.concat(F.lit(f"{seed}:"), name))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        order_key.alias("order_key"),
    ).withColumn("cell", F.substring("order_key", 1, CELL_DIGITS))
    # Written, as the words are counted once for the cells and for the rows.
    sized = written(sized, "sizes")
    # Prefix sums in two steps: over a source's cells, then over the rows of one cell.
    cells = sized.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sources = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    planned = targets(sources, weights, max_epochs)
    before_cell = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        cells.withColumn("before_cell", F.coalesce(F.sum("cell_size").over(before_cell), F.lit(0)))
        .join(planned.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("whole", F.coalesce(F.expr("try_divide(words, source_size)"), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
        .select(
            F.col("source").alias("in_source"), F.col("cell").alias("in_cell"),
            "before_cell", "source_size", "target", "whole", "rest",
        )
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("order_key", "doc_id", "size")
    before_row = F.coalesce(
        F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before_cell") - F.col("before_row")))
    return (
        sized.withColumn("before_row", before_row)
        .join(
            placed,
            F.col("source").eqNullSafe(F.col("in_source")) & (F.col("cell") == F.col("in_cell")),
        )
        .select(
            "doc_id", "size", "source_size", "target",
            (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"),
        )
    )
