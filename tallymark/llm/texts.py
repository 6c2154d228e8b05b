"""What the operators share: the word rule, and reading the given tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and
# carriage return. These are the bytes that ``bytes.split()`` splits on as well.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder, with all its columns."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text as a string, a null one as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def word_count(column: Column) -> Column:
    """Number of words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time, so that one text at a time is in Python's memory."""
    for batch in batches:
        yield from (
            tuple(value.as_py() for value in row) for row in zip(*(batch.column(n) for n in names))
        )


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows never learnt from: the remainder of the key's CRC32, read as text, is ``fold``.

    A null key counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold
