"""The two reporting tables: one row per patient-month, one row per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.calendar import fiscal_month, fiscal_year, reporting_month
from tallymark.functions.text import EvidenceRules
from tallymark.operators.evidence import evidence_per_parent, label_notes
from tallymark.operators.joins import join_dimension

# The youngest eligible age, and the statuses that count as screened.
ELIGIBLE_AGE = 12
CURRENT_USER = "current_user"
KNOWN_STATUSES = (CURRENT_USER, "non_user")

SDOH_FLAGS = ("transportation_barrier", "housing_instability", "food_insecurity")

PERIOD = "reporting_month"
PATIENT_PERIOD_COLUMNS = (
    "patient_id",
    "encounter_id",
    "clinic",
    "coverage_type",
    "age_at_encounter",
    "has_copd",
    "has_diabetes",
    *SDOH_FLAGS,
    "tobacco_screen_status",
    "structured_cessation_intervention",
    "note_intervention",
    "evidence_notes",
    "evidence_phrases",
    "evidence_note_id",
    "evidence_phrase",
    "has_intervention",
)


def patient_month(
    encounters: DataFrame,
    notes: DataFrame,
    assessments: DataFrame,
    rules: EvidenceRules,
    period: str = PERIOD,
) -> DataFrame:
    """Encounters with note evidence, social needs and the flags behind the three rates.

    Notes are collapsed per encounter first, so an encounter keeps one row whatever its
    number of notes. A patient without an assessment keeps NULL flags, a group of their own.
    ``period`` names the encounters' period column; a month, unless said otherwise.
    """
    evidence = evidence_per_parent(label_notes(notes, rules))
    needs = assessments.select("patient_id", *SDOH_FLAGS)
    noted = encounters.join(evidence, "encounter_id", "left")
    joined = join_dimension(noted, needs, "patient_id", how="left")
    structured = F.coalesce(F.col("structured_cessation_intervention"), F.lit(False))
    known = joined.withColumns(
        {
            "note_intervention": F.coalesce(F.col("note_intervention"), F.lit(False)),
            "evidence_notes": F.coalesce(F.col("evidence_notes"), F.lit(0).cast("long")),
            "evidence_phrases": F.coalesce(F.col("evidence_phrases"), F.lit(0).cast("long")),
            "has_intervention": structured | F.coalesce(F.col("note_intervention"), F.lit(False)),
        }
    )
    eligible = F.coalesce(F.col("age_at_encounter") >= ELIGIBLE_AGE, F.lit(False))
    status = F.coalesce(F.col("tobacco_screen_status"), F.lit(""))
    screened = eligible & status.isin(*KNOWN_STATUSES)
    user = eligible & (status == CURRENT_USER)
    flags = {
        "screening_den": eligible,
        "screening_num": screened,
        "cessation_den": user,
        "cessation_num": user & F.col("has_intervention"),
        "combined_den": eligible,
        "combined_num": screened & (~user | F.col("has_intervention")),
        "care_gap": user & ~F.col("has_intervention"),
    }
    return known.select(
        period, *PATIENT_PERIOD_COLUMNS, *[flag.cast("int").alias(name) for name, flag in flags.items()]
    )


def account(
    accounts: DataFrame,
    departments: DataFrame,
    financials: DataFrame,
    encounters: DataFrame | None = None,
    fiscal_start: int = 10,
) -> DataFrame:
    """One row per account: department, primary encounter, amounts and reporting periods.

    ``financials`` has one row per account, ``departments`` one per department, and
    ``encounters`` one per account and encounter. Without ``encounters`` the accounts must
    already carry the encounter columns.

    No account is lost: one without a partner keeps NULL in that partner's columns and
    false in ``has_department``, ``has_encounter`` or ``has_financials``.
    """
    located = join_dimension(
        accounts.withColumnRenamed("discharge_department_id", "department_id"),
        departments.withColumn("has_department", F.lit(True)),
        "department_id",
        "left",
    )
    if encounters is not None:
        # Both ids must match: a row that matches on one of them belongs to another stay.
        renamed = encounters.withColumnRenamed("encounter_id", "primary_encounter_id")
        located = join_dimension(
            located,
            renamed.withColumn("has_encounter", F.lit(True)),
            ["hospital_account_id", "primary_encounter_id"],
            "left",
        )
    joined = join_dimension(
        located, financials.withColumn("has_financials", F.lit(True)), "hospital_account_id", "left"
    )
    flags = ["has_department", "has_financials", *(["has_encounter"] if encounters is not None else [])]
    known = joined.withColumns({name: F.coalesce(F.col(name), F.lit(False)) for name in flags})
    return with_reporting_columns(known, fiscal_start)


def with_reporting_columns(accounts: DataFrame, fiscal_start: int = 10) -> DataFrame:
    """Reporting month, fiscal period and revenue after direct costs of account rows."""
    day = F.col("discharge_date")
    return accounts.withColumns(
        {
            "discharge_month": reporting_month(day),
            "fiscal_year": fiscal_year(day, fiscal_start),
            "fiscal_month": fiscal_month(day, fiscal_start),
            "revenue_after_direct": F.col("estimated_net_revenue") - F.col("total_direct_cost"),
        }
    )
