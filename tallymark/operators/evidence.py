"""Note evidence, its review rows, and its collapse to the parent grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.scopes import ScopeRules, mention_rows, scoped_phrases
from tallymark.functions.text import EvidenceRules, evidence_phrases, matches
from tallymark.operators.joins import collapse, join_dimension


def keyword_candidates(
    notes: DataFrame,
    parents: DataFrame,
    on: str,
    text: str,
    pattern: str,
    parent_filter: Column | None = None,
) -> DataFrame:
    """Notes with a keyword, beside the parent facts that pass a filter.

    Both sides are filtered before the join. A keyword alone does not make evidence.
    """
    chosen = parents if parent_filter is None else parents.where(parent_filter)
    return join_dimension(notes.where(matches(text, pattern)), chosen, on)


def supporting(text: str, rules: EvidenceRules | ScopeRules) -> Column:
    """Every supporting clause, by patterns of a clause or by scopes of its mentions."""
    return scoped_phrases(text, rules) if isinstance(rules, ScopeRules) else evidence_phrases(text, rules)


def label_notes(notes: DataFrame, rules: EvidenceRules | ScopeRules, text: str = "note_text") -> DataFrame:
    """Every note with its label, its supporting phrases and their number; no shuffle."""
    return notes.withColumn("phrases", supporting(text, rules)).withColumns(
        {
            "n_phrases": F.size("phrases"),
            "label": F.when(F.size("phrases") > 0, "provided").otherwise("not_provided"),
        }
    )


def mentions(notes: DataFrame, rules: ScopeRules, *keys: str, text: str = "note_text") -> DataFrame:
    """The review table of scopes: a row for each mention, with its clause and what it is in."""
    return notes.select(*keys, F.inline(mention_rows(text, rules)))


def known_texts(
    texts: DataFrame, known: DataFrame, rules: EvidenceRules | ScopeRules, text: str = "note_text", expected: str = "expected"
) -> DataFrame:
    """Texts of known standing (``known``: a text and its expected label), against the rules.

    Every known text with the rows that hold it, what the rules say of it, and whether that
    is as expected. One that no row holds says nothing (NULL). Rows are counted where they
    are, so a text that very many rows hold is one row of each task.
    """
    found = (
        texts.join(known.select(text).distinct(), text, "left_semi")
        .groupBy(text)
        .agg(F.count("*").alias("rows"))
        .withColumn("provided", F.size(supporting(text, rules)) > 0)
    )
    return known.join(found, text, "left").select(
        text, expected, F.coalesce("rows", F.lit(0)).alias("rows"), "provided", (F.col("provided") == F.col(expected)).alias("agrees")
    )


def phrase_rows(labelled: DataFrame, *keys: str) -> DataFrame:
    """The review table: a row for each supporting phrase, with its place in the note."""
    placed = F.posexplode("phrases").alias("place", "phrase")
    return labelled.select(*keys, placed)


def evidence_per_parent(
    labelled: DataFrame, parent: str = "encounter_id", note_id: str = "note_id"
) -> DataFrame:
    """One row per parent with evidence: number of notes and phrases, and the first of each.

    The whole list stays in the review table; here every column is a mergeable aggregate,
    so no parent's notes are gathered in one task.
    """
    positive = labelled.where(F.col("n_phrases") > 0)
    first = F.min(F.struct(F.col(note_id), F.get("phrases", F.lit(0)).alias("phrase")))
    collapsed = collapse(
        positive,
        parent,
        F.lit(True).alias("note_intervention"),
        F.count("*").alias("evidence_notes"),
        F.sum("n_phrases").alias("evidence_phrases"),
        first.alias("_first"),
    )
    return collapsed.select(
        parent,
        "note_intervention",
        "evidence_notes",
        "evidence_phrases",
        F.col(f"_first.{note_id}").alias("evidence_note_id"),
        F.col("_first.phrase").alias("evidence_phrase"),
    )


def representative(frame: DataFrame, key: str, text: str) -> DataFrame:
    """The smallest key of each distinct text. Copies are merged before the shuffle."""
    return frame.groupBy(text).agg(F.min(key).alias(key)).select(key, text)


def contrast_sample(
    notes: DataFrame, texts: Sequence[str], rules: EvidenceRules | ScopeRules, key: str = "note_id", text: str = "note_text"
) -> DataFrame:
    """One note of each chosen text, with its label."""
    chosen = notes.where(F.col(text).isin(*texts))
    return label_notes(representative(chosen, key, text), rules, text).select(key, text, "label")
