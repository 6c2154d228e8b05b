"""Rule-based evidence in free text.

A text is cut into clauses. A clause is evidence if it tells of care, has the topic (in
itself, or in the clause before unless it names another topic), is not excluded, and is
not refused in the clause that follows. All rules are parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column

NOTHING = r"(?!)"  # matches no text


@dataclass(frozen=True)
class EvidenceRules:
    """Patterns of a clause, and ``boundary``, which ends one.

    ``care``: what counts if done. ``topic``: what it must be about. ``other_topic``: what
    a clause is about that has no topic of its own, so that the one before says nothing.
    ``excluded``: clauses in which the care was not given, or not to the person concerned.
    ``refusal``: a whole clause that takes back the one before.
    """

    care: str
    topic: str = ""
    other_topic: str = NOTHING
    excluded: str = NOTHING
    refusal: str = NOTHING
    boundary: str = r"[.;!?\n]+"


def matches(text: Column | str, pattern: str) -> Column:
    """Case-sensitive unanchored match."""
    return as_column(text).rlike(pattern)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once for the row, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def evidence_phrases(text: Column | str, rules: EvidenceRules) -> Column:
    """Every supporting clause in the text's order, trimmed; empty without evidence."""
    clauses = F.transform(F.split(as_column(text), rules.boundary), lambda clause: F.trim(clause))

    def supporting(parts: Column) -> Column:
        size = F.size(parts)
        none = F.array(F.lit(""))
        before = F.concat(none, F.slice(parts, F.lit(1), size - 1))
        after = F.concat(F.slice(parts, F.lit(2), size), none)
        beside = F.arrays_zip(parts.alias("clause"), before.alias("before"), after.alias("after"))

        def holds(entry: Column) -> Column:
            clause = entry["clause"]
            about = clause.rlike(rules.topic) | (
                entry["before"].rlike(rules.topic) & ~clause.rlike(rules.other_topic)
            )
            given = clause.rlike(rules.care) & about & ~clause.rlike(rules.excluded)
            return given & ~entry["after"].rlike(rules.refusal)

        return F.transform(F.filter(beside, holds), lambda entry: entry["clause"])

    empty = F.array().cast("array<string>")
    return F.coalesce(_bind(clauses, supporting), empty)
