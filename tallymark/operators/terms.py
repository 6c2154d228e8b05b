"""Texts with given terms, by a positional index: terms are rows, and no pattern is made of them.

The index has a row for every word of every text, with its place and the word after it. A
term of several words occurs where its words stand side by side, so it is a chain of pairs:
each word with the next. It is looked up by its rarest pair; only at those places are its
other pairs compared, by a join on text and place. Rows whose pair no term has are dropped
before anything is grouped or joined by place: in prose most pairs are rare, while most words
of a term are in very many texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column
from tallymark.sources.staging import written

WORD = r"[\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """The words of a text in lower case, in order; none in a NULL."""
    found = F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _paired(split: DataFrame, *kept: Column | str, words: str, at: str) -> DataFrame:
    """The kept columns, ``at, word, next``: a row for every word of an array of words."""
    pairs = F.arrays_zip(F.col(words).alias("word"), F.slice(words, F.lit(2), F.size(words)).alias("next"))
    return split.select(*kept, F.posexplode(pairs).alias(at, "_pair")).select(*kept, at, "_pair.word", "_pair.next")


def index(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``key, at, word, next``: every word of every text, its place from 0 and the word after
    it, NULL after the last."""
    return _paired(texts.select(key, words(text).alias("_words")), key, words="_words", at="at")


def dictionary(terms: DataFrame, term: str) -> DataFrame:
    """``term, n_words, nth, word, next``: the words of every different term, each with the
    one after it. One without words is left out: it occurs nowhere."""
    split = terms.select(term).distinct().withColumn("_words", words(term)).withColumn("n_words", F.size("_words"))
    return _paired(split, term, "n_words", words="_words", at="nth")


def occurrences(indexed: DataFrame, terms: DataFrame, key: str, term: str) -> DataFrame:
    """``key, term, at``: every place where a term begins, overlaps included.

    ``indexed`` is an ``index``; it is read once for the pairs of all terms, and once more if
    there are terms of one word. The different pairs are written first, so that this join is
    planned from their real size: while they are small enough to broadcast, the index is cut
    to them as it is scanned. The rows left are written too, and all later steps read those,
    so what is shuffled grows with the pairs found and not with the texts. The joins are on
    values that each row has, so a pair that very many texts hold is split by adaptive
    execution; a term is found by its rarest pair, so it seldom is one.
    """
    pair = ["word", "next"]
    entries = dictionary(terms, term)
    single = indexed.join(entries.where("n_words = 1").select(term, "word"), "word").select(key, term, "at")
    entries = entries.where(F.col("next").isNotNull())
    pairs = written(entries.select(pair).distinct(), "term-pairs")
    near = written(indexed.join(pairs, pair, "left_semi").select(key, "at", *pair), "term-places")
    used = near.groupBy(pair).agg(F.count("*").alias("_rows"))
    rarity = Window.partitionBy(term).orderBy("_rows", "nth")
    # A term with a pair that no text has is gone after the join, and is dropped as a whole.
    ranked = entries.join(used, pair).withColumn("_rank", F.row_number().over(rarity)).withColumn(
        "_known", F.count("*").over(Window.partitionBy(term))
    )
    ranked = written(ranked.where(F.col("_known") == F.col("n_words") - 1), "term-ranks")
    looked = ranked.where("_rank = 1").select(term, "n_words", F.col("nth").alias("_nth"), *pair)
    begins = near.join(looked, pair).select(key, term, "n_words", (F.col("at") - F.col("_nth")).alias("at"))
    begins = begins.where("at >= 0")
    double = begins.where("n_words = 2").select(key, term, "at")
    rest = ranked.where("_rank > 1").select(F.col(term).alias("_term"), "nth", *pair)
    wanted = begins.where("n_words > 2").join(rest, F.col(term) == F.col("_term")).select(
        key, term, "n_words", F.col("at").alias("_begin"), (F.col("at") + F.col("nth")).alias("at"), *pair
    )
    matched = wanted.join(near, [key, "at", *pair]).groupBy(key, term, "n_words", F.col("_begin").alias("at")).agg(
        F.count("*").alias("_matched")
    )
    found = matched.where("_matched = n_words - 2").select(key, term, "at")
    return single.unionByName(double).unionByName(found)


def candidates(texts: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """``key, term, times``: the texts that hold a term, and how often."""
    found = occurrences(index(texts, key, text), terms, key, term)
    return found.groupBy(key, term).agg(F.count("*").alias("times"))
