"""Quality reporting over activity: what a user did in a week, and what was written about it.

A week of a user's events is an encounter. A turn of a conversation is a note of the user
that the conversation is numbered after, in the week that the turn is numbered after. The
customer of that number gives the one-row attributes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.calendar import reporting_week
from tallymark.functions.coding import decode_flag, map_values
from tallymark.functions.scopes import BACKWARD, BOTH, NEGATED, PAST, PLANNED, Cue, End, Lift, Mention, ScopeRules
from tallymark.functions.text import EvidenceRules
from tallymark.operators import gold as gold_tables
from tallymark.operators.conform import conform
from tallymark.operators.joins import collapse, only_of
from tallymark.sources.tables import load

PERIOD = "reporting_week"
FIRST_WEEK = dt.date(2024, 1, 1)  # week 0
WEEKS_OF_TURNS = 5
STATUS_OF_EVENT = {"purchase": "current_user", "click": "current_user", "view": "non_user", "signup": "unknown"}
STATUS_OTHERWISE = "not_done"
INTERVENTION_VALUE = 60
WIDE = 1_000_000  # weeks of a user, turns of a conversation


def whole_word(words: str) -> str:
    """One of some words, with no letter on either side."""
    return r"(?<!\p{L})(?:" + words + r")(?!\p{L})"


# The given texts are invented prose, so these terms are ordinary words of it. The rules for
# real notes are ``fixed_values.NOTE_RULES``; hand-labelled notes test those.
# Word ends are spelled out, as engines differ on what ``\\b`` means beside accented letters.
TURN_RULES = EvidenceRules(
    care=r"(^|\P{L})(that|avec|nicht|por)(\P{L}|$)",
    topic=r"(?i)(^|\P{L})(the|la|der|el)(\P{L}|$)",
    other_topic=r"(^|\P{L})(from|pour|auf|con)(\P{L}|$)",
    excluded=r"(^|\P{L})(was|dans|zu|los)(\P{L}|$)",
    refusal=r"^\S+$",
)

# The same words as cues of scopes: what was not done, what is past, what is planned.
TURN_SCOPES = ScopeRules(
    mentions=(Mention("care", whole_word("that|avec|nicht|por")),),
    cues=(
        Cue(whole_word("was|dans|zu|los"), NEGATED),
        Cue(whole_word("and|et|und|y"), PAST, BACKWARD),
        Cue(whole_word("of|de|von"), PLANNED, BOTH),
    ),
    ends=(End(",", NEGATED | PLANNED),),
    lifts=(Lift(whole_word("is|est|ist|es"), PLANNED),),
    topic=whole_word("the|la|der|el"),
    other_topic=whole_word("from|pour|auf|con"),
    refusal=r"^\s*\S+\s*$",
)


def numbered(first: Column, second: Column) -> Column:
    """One number of two. The second must be below ``WIDE``, as else two pairs would share one."""
    fits = (second >= 0) & (second < WIDE)
    wrong = F.raise_error(F.concat(F.lit(f"not below {WIDE}: "), second.cast("string")))
    return F.when(fits, first * WIDE + second).when(second.isNotNull(), wrong.cast("long"))


def encounters(spark: SparkSession, folder: str, chosen: Column | None = None) -> DataFrame:
    """One row per user and week, from mergeable aggregates of the week's events.

    ``chosen`` is a condition on the stored ``ts``. It must take whole weeks.
    """
    events = load(spark, folder, "events")
    if chosen is not None:
        events = events.where(chosen)
    events = events.select(
        "user_id",
        reporting_week(F.col("ts").cast("date")).alias(PERIOD),
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("age"),
        F.struct("ts", "event_id").alias("at"),
    )
    weeks = collapse(
        events,
        ["user_id", PERIOD],
        F.max("at").alias("last_at"),
        F.max_by("event_type", "at").alias("last_type"),
        F.min_by("event_type", "at").alias("first_type"),
        F.max_by("age", "at").alias("age"),
        F.bool_or(F.col("event_type") == "error").alias("has_error"),
        F.max("value").alias("largest"),
        F.bool_or((F.col("event_type") == "purchase") & (F.col("value") >= INTERVENTION_VALUE)).alias("bought"),
    )
    day = F.col("last_at.ts").cast("date")
    hours = F.floor(F.hour("last_at.ts") / 6).cast("int")
    return conform(
        weeks,
        {
            "encounter_id": numbered(F.col("user_id"), F.floor(F.datediff(F.col(PERIOD), F.lit(FIRST_WEEK)) / 7)),
            "patient_id": F.col("user_id"),
            "encounter_date": day,
            PERIOD: F.col(PERIOD),
            "clinic": F.concat(F.lit("hours "), (hours * 6).cast("string"), F.lit("+")),
            "coverage_type": F.col("first_type"),
            "age_at_encounter": F.col("age"),
            "has_copd": F.col("has_error"),
            "has_diabetes": F.col("largest") > 100,
            "tobacco_screen_status": map_values("last_type", STATUS_OF_EVENT, STATUS_OTHERWISE),
            "structured_cessation_intervention": F.col("bought"),
        },
    )


def notes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per turn, keyed by conversation and turn."""
    return conform(
        load(spark, folder, "conversations"),
        {
            "note_id": numbered(F.col("conv_id"), F.col("turn")),
            "patient_id": F.col("conv_id"),
            "encounter_id": numbered(F.col("conv_id"), F.col("turn") % WEEKS_OF_TURNS),
            "note_type": F.col("role"),
            "note_text": F.col("text"),
        },
    )


def assessments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: three flags."""
    return conform(
        load(spark, folder, "customer"),
        {
            "patient_id": F.col("c_custkey"),
            "transportation_barrier": F.col("c_acctbal") < 0,
            "housing_instability": decode_flag("c_mktsegment", "HOUSEHOLD"),
            "food_insecurity": F.col("c_nationkey") < 5,
        },
    )


def gold(spark: SparkSession, folder: str, chosen: Column | None = None) -> DataFrame:
    """One row per user and week that has events; with ``chosen``, of those weeks only, and
    only their notes are read for evidence."""
    weeks, written_notes = encounters(spark, folder, chosen), notes(spark, folder)
    if chosen is not None:
        written_notes = only_of(written_notes, weeks, "encounter_id")
    return gold_tables.patient_month(weeks, written_notes, assessments(spark, folder), TURN_RULES, PERIOD)
