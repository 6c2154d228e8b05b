"""Lines that many documents share, kept in one document only.

Lines are exploded, normalised and hashed; distinct documents are counted for each hash;
lines over the threshold are dropped and the rest put together again by position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.shared import fresh, written
from tallymark.llm.texts import BLANKS, lower_ascii, text_or_empty

SMALLEST = -(2**63)  # stands for a null doc_id
RESULT = "n_lines long, n_dropped long, text string"


def line_key(line: Column) -> Column:
    """What makes lines equal: blanks stripped at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``id, hash, line``: 128-bit hashes of the different line keys of each row, if long
    enough, by the row's ``doc_id`` and a hash of its text."""
    keys = F.transform(F.split(text_or_empty("text"), "\n"), line_key)
    long_keys = F.filter(F.array_distinct(keys), lambda key: F.length(key) >= min_chars)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST)).alias("id")
    return docs.select(ident, _text_hash().alias("hash"), F.explode(F.transform(long_keys, _hash)).alias("line"))


def _text_hash() -> Column:
    """Tells rows apart that share a ``doc_id`` or have none."""
    return F.xxhash64(text_or_empty("text"))


def shared_lines(pairs: DataFrame, min_docs: int) -> DataFrame:
    """``line, last``: hashes in at least ``min_docs`` documents, and the largest id of these.

    Repeats of a document are taken out by (line, id) first, so a line that a third of all
    documents hold is counted in partial sums and never meets in one task.
    """
    return (
        pairs.groupBy("line", "id").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.sum("one").alias("n_docs"), F.max("id").alias("last"))
        .where(F.col("n_docs") >= min_docs)
        .select("line", "last")
    )


def _without(text: str | None, drops) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    if drops is None:
        return len(lines), 0, text or ""
    drops = {bytes(one) for one in drops}
    blanks = BLANKS.encode()

    def stays(line: str) -> bool:
        return hashlib.md5(line.encode().strip(blanks).lower()).digest() not in drops

    kept = [line for line in lines if stays(line)]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _reassembled(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, drops in parts:
        rows = [_without(text, drop) for text, drop in zip(texts, drops)]
        yield pd.DataFrame(rows, columns=["n_lines", "n_dropped", "text"])


def _with_cut(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, str]:
    """The rows with a struct of the remaining text and its counts, and the struct's name."""
    # Written, as lines are split and hashed once for the counts and for the drops.
    pairs = written(line_hashes(docs, min_chars), "line-hashes")
    # Written, so that the join sees both sides' real sizes and can split a hot line.
    frequent = written(shared_lines(pairs, min_docs), "shared-lines")
    # A row's drops come from its own text, so no array is larger than its text.
    drops = (
        pairs.join(frequent, "line").where("id < last")
        .groupBy("id", "hash").agg(F.collect_set("line").alias("drops"))
    )
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST))
    of, hashed, dropped, cut = fresh(docs, "id", "hash", "drops", "cut")
    numbered = docs.select("*", ident.alias(of), _text_hash().alias(hashed))
    joined = numbered.join(drops.withColumnsRenamed({"id": of, "hash": hashed, "drops": dropped}), [of, hashed], "left")
    reassembled = F.pandas_udf(_reassembled, RESULT)
    return joined.withColumn(cut, reassembled(F.col("text").cast("string"), F.col(dropped))), cut


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` with the remaining ``text``, and ``n_lines, n_dropped``.

    A line goes if its key has ``min_chars`` code points or more, ``min_docs`` documents or
    more hold the key, and another document with a larger ``doc_id`` holds it. Documents
    are told apart by ``doc_id``; a null one counts as one document, below all others.
    A null or empty text is one empty line; a text that loses all its lines is empty.
    Repeated rows are cut alike. A column that is already called ``n_lines`` or
    ``n_dropped`` is replaced. No rows give no rows.
    """
    rest = docs.select(*[f"`{name}`" for name in docs.columns if name not in ("n_lines", "n_dropped")])
    result, cut = _with_cut(rest, min_chars, min_docs)
    return result.select(*_columns(rest, cut), f"{cut}.n_lines", f"{cut}.n_dropped")


def cut_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The columns of ``docs``, of which the text alone is cut; see ``dedup_lines``."""
    result, cut = _with_cut(docs, min_chars, min_docs)
    return result.select(*_columns(docs, cut))


def _columns(docs: DataFrame, cut: str) -> list[Column]:
    return [F.col(f"{cut}.text").alias("text") if name == "text" else F.col(f"`{name}`") for name in docs.columns]
