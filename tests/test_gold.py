import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks, gold, measures
from tallymark.plans import fixed_values as fixed

GIVEN = "Discussed stopping tobacco and referred the patient to the quitline during this visit."
ALSO_GIVEN = "Counseled the patient on tobacco cessation today; nicotine gum given."
DECLINED = "Current tobacco use documented. Patient declined cessation counseling today."
ENCOUNTERS = (
    "encounter_id long, patient_id long, reporting_month date, clinic string, coverage_type string, "
    "age_at_encounter int, has_copd boolean, has_diabetes boolean, tobacco_screen_status string, "
    "structured_cessation_intervention boolean"
)
ASSESSMENTS = "patient_id long, transportation_barrier boolean, housing_instability boolean, food_insecurity boolean"


def encounter(number, patient, status="current_user", structured=False, age=40, month=1, clinic="NORTH"):
    return (number, patient, dt.date(2026, month, 1), clinic, "Other", age, False, False, status, structured)


def build(spark, encounters, notes=(), assessments=((1, True, False, False),)):
    return gold.patient_month(
        spark.createDataFrame(list(encounters), ENCOUNTERS),
        spark.createDataFrame(list(notes), "note_id long, encounter_id long, note_text string"),
        spark.createDataFrame(list(assessments), ASSESSMENTS),
        fixed.NOTE_RULES,
    )


def test_any_number_of_notes_keeps_one_row(spark):
    encounters = [encounter(n, n) for n in (1, 2, 3, 4)]
    notes = [(21, 2, GIVEN), (31, 3, DECLINED), (32, 3, GIVEN), (41, 4, GIVEN), (42, 4, ALSO_GIVEN), (43, 4, DECLINED)]
    rows = {r.encounter_id: r for r in build(spark, encounters, notes).collect()}
    assert len(rows) == 4
    assert [rows[n].note_intervention for n in (1, 2, 3, 4)] == [False, True, True, True]
    assert [rows[n].evidence_notes for n in (1, 2, 3, 4)] == [0, 1, 1, 2]
    assert [rows[n].evidence_phrases for n in (1, 2, 3, 4)] == [0, 1, 1, 3]
    assert (rows[4].evidence_note_id, rows[4].evidence_phrase) == (41, GIVEN.rstrip("."))
    assert rows[1].evidence_phrase is None


def test_a_note_counts_for_its_own_encounter_only(spark):
    rows = {r.encounter_id: r for r in build(spark, [encounter(1, 1), encounter(2, 1, month=2)], [(21, 2, GIVEN)]).collect()}
    assert (rows[1].care_gap, rows[2].care_gap) == (1, 0)


@pytest.mark.parametrize(
    "status, given, flags",
    [
        # screening den/num, cessation den/num, combined den/num, gap
        ("current_user", True, (1, 1, 1, 1, 1, 1, 0)),
        ("current_user", False, (1, 1, 1, 0, 1, 0, 1)),
        ("non_user", False, (1, 1, 0, 0, 1, 1, 0)),
        ("non_user", True, (1, 1, 0, 0, 1, 1, 0)),
        ("unknown", False, (1, 0, 0, 0, 1, 0, 0)),
        ("not_done", True, (1, 0, 0, 0, 1, 0, 0)),
        (None, False, (1, 0, 0, 0, 1, 0, 0)),
    ],
)
def test_truth_table(spark, status, given, flags):
    row = build(spark, [encounter(1, 1, status, given)]).first()
    names = ["screening_den", "screening_num", "cessation_den", "cessation_num", "combined_den", "combined_num", "care_gap"]
    assert tuple(row[name] for name in names) == flags


def test_children_enter_no_denominator(spark):
    rows = build(spark, [encounter(1, 1, age=11), encounter(2, 2, age=12), encounter(3, 3, age=None)]).collect()
    assert {r.encounter_id: r.screening_den + r.cessation_den + r.care_gap for r in rows} == {1: 0, 2: 3, 3: 0}


def test_patient_without_assessment_is_a_group_of_its_own(spark):
    rows = build(spark, [encounter(1, 1), encounter(2, 2)])
    groups = measures.evaluate(rows, measures.CLINICAL, ["transportation_barrier"]).collect()
    assert {g.transportation_barrier: g.screening_den for g in groups} == {True: 1, None: 1}


def test_rates_are_ratios_of_sums(spark):
    rows = build(
        spark,
        [encounter(1, 1, structured=True), encounter(2, 2), encounter(3, 3), encounter(4, 4, "non_user", clinic="EAST")],
    )
    total = measures.evaluate(rows, measures.CLINICAL).first()
    assert (total.cessation_num, total.cessation_den, total.cessation_rate) == (1, 3, 0.333333)
    assert total.care_gaps == total.cessation_den - total.cessation_num
    by_clinic = {r.clinic: r for r in measures.evaluate(rows, measures.CLINICAL, ["clinic"]).collect()}
    assert (by_clinic["EAST"].cessation_den, by_clinic["EAST"].cessation_rate) == (0, None)
    none = measures.evaluate(rows, measures.CLINICAL, where=F.lit(False)).first()
    assert (none.screening_den, none.screening_rate) == (0, None)


def test_one_patient_with_a_third_of_all_encounters(spark):
    encounters = [encounter(n, 1 if n % 3 == 0 else n) for n in range(1, 301)]
    notes = [(n, 3, GIVEN if n % 2 else DECLINED) for n in range(1, 101)]
    assessments = [(n, n % 2 == 0, False, False) for n in range(1, 301)]
    result = build(spark, encounters, notes, assessments)
    assert result.count() == 300
    assert result.where(F.col("encounter_id") == 3).first().evidence_notes == 50
    assert result.where(F.col("patient_id") == 1).count() == 101


ACCOUNT = (
    "hospital_account_id long, patient_id long, primary_encounter_id long, discharge_department_id int, "
    "discharge_date date, total_charges decimal(18,2)"
)
PRIMARY = "encounter_id long, hospital_account_id long, patient_type string, surgical_case_flag boolean, ms_drg_weight double"


def hospital(spark):
    cash = Decimal("100.00")
    accounts = [
        (1, 1, 11, 101, dt.date(2025, 9, 30), cash),
        (2, 1, 12, 102, dt.date(2025, 10, 1), cash),
        (3, 2, 13, 101, dt.date(2025, 10, 2), cash),
        (4, 3, 14, 101, dt.date(2025, 10, 3), cash),
    ]
    primary = [
        (11, 1, "Inpatient", True, 2.0),
        (12, 2, "Outpatient", False, 9.0),
        (13, 3, "Inpatient", False, None),
        (14, 99, "Inpatient", False, 1.0),
    ]
    money = [(n, Decimal("50.10"), Decimal("20.05"), Decimal("5.00"), Decimal("45.00")) for n in (1, 2, 3, 4)]
    return (
        spark.createDataFrame(accounts, ACCOUNT),
        spark.createDataFrame([(101, "M", "E", "V"), (102, "M", "E", "O")], "department_id int, facility string, service_line string, product string"),
        spark.createDataFrame(
            money,
            "hospital_account_id long, estimated_net_revenue decimal(18,2), total_direct_cost decimal(18,2), "
            "total_indirect_cost decimal(18,2), total_actual_payment decimal(18,2)",
        ),
        spark.createDataFrame(primary, PRIMARY),
    )


def test_account_gold_joins_on_both_keys(spark):
    accounts, departments, financials, primary = hospital(spark)
    result = gold.account(accounts, departments, financials, primary)
    rows = {r.hospital_account_id: r for r in result.collect()}
    # Account 4 stays, but the row that shares only its encounter's id is not its partner.
    assert set(rows) == {1, 2, 3, 4}
    assert {n: r.has_encounter for n, r in rows.items()} == {1: True, 2: True, 3: True, 4: False}
    assert rows[4].patient_type is None and rows[4].total_charges == Decimal("100.00")
    assert (rows[1].fiscal_year, rows[1].fiscal_month, rows[2].fiscal_year, rows[2].fiscal_month) == (2025, 12, 2026, 1)
    assert rows[1].revenue_after_direct == Decimal("30.05")
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(\(hospital_account_id#\d+L = hospital_account_id#\d+L\) AND", plan)
    keys = {"primary_encounter_id": "encounter_id", "hospital_account_id": "hospital_account_id"}
    lost = checks.orphans(accounts, primary, keys).collect()
    assert [(r.primary_encounter_id, r.row_count) for r in lost] == [(14, 1)]
    reconciled = checks.reconcile({"accounts": (accounts, {"charges": ("total_charges", "total_charges")})}, result)
    assert {r.total: r.difference for r in reconciled.collect()} == {"rows": 0, "charges": 0}


def test_an_account_without_partners_stays(spark):
    accounts, departments, financials, _ = hospital(spark)
    result = gold.account(accounts, departments.where("department_id = 101"), financials.where("hospital_account_id > 1"))
    rows = {r.hospital_account_id: r for r in result.collect()}
    assert len(rows) == 4
    assert (rows[2].has_department, rows[2].facility, rows[2].has_financials) == (False, None, True)
    assert (rows[1].has_financials, rows[1].estimated_net_revenue, rows[1].revenue_after_direct) == (False, None, None)


def test_finance_measures(spark):
    accounts, departments, financials, primary = hospital(spark)
    result = gold.account(accounts, departments, financials, primary)
    total = measures.evaluate(result, measures.FINANCE).first()
    assert (total.patients, total.encounters, total.surgical_cases) == (3, 4, 1)
    assert total.case_mix_index == 2.0  # neither the outpatient weight nor the missing one
    assert total.revenue_after_direct == Decimal("120.20")
    groups = measures.evaluate(result, measures.FINANCE, ["product"]).collect()
    assert sum(g.patients for g in groups) == 4 > total.patients
    assert sum(g.net_revenue for g in groups) == total.net_revenue
    with pytest.raises(ValueError):
        measures.pick(measures.FINANCE, "profit")
    view = measures.finance_view(result)
    assert view.by("product").exceptAll(measures.evaluate(result, measures.FINANCE, ["product"])).isEmpty()
    assert set(view.dimensions) <= set(result.columns) | {"financial_class_group"}
    with pytest.raises(ValueError):
        view.by("surgeon")
