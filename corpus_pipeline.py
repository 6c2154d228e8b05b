"""From raw documents to a training mix: the stages, and running them one after another.

Each stage's rows are written as Parquet to shared storage and read again as the next
stage's documents, so a lost executor costs no more than a part of the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontamination, line_dedup, mixing, quality, simhash
from tallymark.llm.queries import BITS_APART, EPOCHS, LINE_CHARS, LINE_DOCS, SHINGLE, WEIGHTS
from tallymark.llm.shared import written
from tallymark.llm.texts import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Byte hashes, connected components and edit distances are no SQL; tests hold run()
# against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document holds as well.

    A document that loses all its lines stays, empty; ``n_chars`` follows the text.
    """
    cut = line_dedup.cut_lines(docs, LINE_CHARS, LINE_DOCS)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``."""
    return simhash.keep_first(docs, SHINGLE, BITS_APART)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document (``taken``), one row for each."""
    return mixing.mix(docs, WEIGHTS, EPOCHS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mixing", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
