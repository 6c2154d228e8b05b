"""Scopes of mentions, and the note rules against notes labelled by hand."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions import scopes
from tallymark.functions.scopes import BACKWARD, BOTH, NEGATED, OFFERED, PAST, PLANNED, Cue, End, Lift, Mention, ScopeRules
from tallymark.operators import checks, evidence
from tallymark.plans import fixed_values as fixed
from tests.labelled_notes import FRESH, NOTES, UNSEEN

RULES = ScopeRules(
    mentions=(Mention("care", r"\bcare\b"), Mention("drug", r"\bdrug\b", needs=r"\bgave\b")),
    cues=(
        Cue(r"\bno\b", NEGATED),
        Cue(r"\bdeclined\b", NEGATED, BOTH),
        Cue(r"\bbefore\b", PAST, BACKWARD),
        Cue(r"\blater\b", PLANNED, BOTH),
        Cue(r"\boffered\b", OFFERED, BOTH),
    ),
    ends=(End(r",", NEGATED | PLANNED),),
    lifts=(Lift(r"\btoday\b", PAST | PLANNED), Lift(r"\btook\b", OFFERED, before=True)),
    neutral=(r"\bno doubt\b",),
    refusal=r"^\W*refused\W*$",
)


def read(spark, text, rules=RULES):
    rows = spark.range(1).select(F.inline(scopes.mention_rows(F.lit(text), rules))).collect()
    return [(r.clause, r["name"], r.taken, {s for s in scopes.SCOPES if r[s]}) for r in rows]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("care", [(0, "care", False, set())]),
        ("No care, care", [(0, "care", False, {"negated"}), (0, "care", False, set())]),
        ("care no care", [(0, "care", False, set()), (0, "care", False, {"negated"})]),
        ("care declined care", [(0, "care", False, {"negated"}), (0, "care", False, {"negated"})]),
        ("care before care", [(0, "care", False, {"past"}), (0, "care", False, set())]),
        ("no doubt care", [(0, "care", False, set())]),
        ("care later today", [(0, "care", False, set())]),
        # A cue within its own scope reaches no further back.
        ("care and no care declined", [(0, "care", False, set()), (0, "care", False, {"negated"})]),
        ("no care. care", [(0, "care", False, {"negated"}), (1, "care", False, set())]),
        ("care. Refused.", [(0, "care", True, set())]),
        ("care. Refused care.", [(0, "care", False, set()), (1, "care", False, set())]),
        ("offered care. He took it.", [(0, "care", False, set())]),
        ("offered care. took care", [(0, "care", False, {"offered"}), (1, "care", False, set())]),
        ("drug. gave drug", [(1, "drug", False, set())]),
        ("careless", []),
    ],
)
def test_scopes(spark, text, expected):
    assert read(spark, text) == expected


def test_no_text_and_no_rules(spark):
    frame = spark.createDataFrame([(None,), ("",), ("care",)], "t string")
    found = frame.select(scopes.scoped_phrases("t", RULES).alias("p")).collect()
    assert [r.p for r in found] == [[], [], ["care"]]


@pytest.mark.parametrize("notes", [NOTES, UNSEEN, FRESH], ids=["known", "unseen", "fresh"])
def test_note_rules(spark, notes):
    frame = spark.createDataFrame([(i, text, good) for i, (text, good) in enumerate(notes)], "note_id int, note_text string, good boolean")
    labelled = evidence.label_notes(frame, fixed.NOTE_RULES).withColumn("provided", F.col("n_phrases") > 0)
    wrong = checks.disagreements(labelled, "good", "provided").collect()
    assert [r.note_text for r in wrong] == []


def test_phrases_are_the_clauses_as_written(spark):
    text = "  Smoker. Counseled on quitting tobacco; Nicotine gum given! Declined diet advice."
    frame = spark.createDataFrame([(1, text)], "note_id int, note_text string")
    (row,) = evidence.label_notes(frame, fixed.NOTE_RULES).collect()
    assert row.phrases == ["Counseled on quitting tobacco", "Nicotine gum given"]
    assert [tuple(r) for r in evidence.phrase_rows(evidence.label_notes(frame, fixed.NOTE_RULES), "note_id").collect()] == [
        (1, 0, "Counseled on quitting tobacco"), (1, 1, "Nicotine gum given")
    ]


def test_scopes_run_without_python_and_without_a_shuffle(spark):
    frame = spark.createDataFrame([(1, "care")], "note_id int, note_text string").repartition(2).cache()
    plan = evidence.mentions(frame, RULES, "note_id")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("InMemoryTableScan")[0]
    assert "Python" not in above and "Exchange" not in above


def test_known_texts(spark):
    texts = spark.createDataFrame([("care",)] * 3 + [("no care",), ("careless",), (None,)], "note_text string")
    known = spark.createDataFrame([("care", True), ("no care", True), ("careless", False), ("care later", False)], "note_text string, expected boolean")
    judged = evidence.known_texts(texts, known, RULES)
    assert sorted(map(tuple, judged.collect())) == [
        ("care", True, 3, True, True), ("care later", False, 0, None, None), ("careless", False, 1, False, True),
        ("no care", True, 1, False, False),
    ]
    (counts,) = checks.agreement(judged, "expected", "provided", "rows").collect()
    assert tuple(counts) == (3, 0, 1, 1, 0, 1.0, 0.75)
    (plain,) = checks.agreement(judged, "expected", "provided").collect()
    assert tuple(plain)[:5] == (1, 0, 1, 1, 1)
    assert sorted(r.note_text for r in checks.disagreements(judged, "expected", "provided").collect()) == ["care later", "no care"]
    with pytest.raises(AssertionError):
        checks.require_known(judged, "expected", "provided")
    checks.require_known(judged.where("note_text in ('care', 'careless')"), "expected", "provided")
