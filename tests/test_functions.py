import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark.functions import calendar, coding, text
from tallymark.operators import evidence
from tallymark.plans import fixed_values as fixed
from tests.labelled_notes import NOTES


def values(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def day(value):
    return F.lit(dt.date.fromisoformat(value))


def test_fiscal_year_starts_in_october(spark):
    dates = ["2025-09-30", "2025-10-01", "2025-12-31", "2026-01-01"]
    found = [values(spark, calendar.fiscal_year(day(d)), calendar.fiscal_month(day(d))) for d in dates]
    assert found == [(2025, 12), (2026, 1), (2026, 3), (2026, 4)]
    assert values(spark, calendar.fiscal_year(day("2026-05-31"), 1), calendar.fiscal_month(day("2026-05-31"), 1)) == (2026, 5)
    with pytest.raises(ValueError):
        calendar.fiscal_year(day("2026-05-31"), 13)


def test_latest_complete_month(spark):
    cases = {"2026-09-20": "2026-08-01", "2026-08-31": "2026-08-01", "2024-02-28": "2024-01-01", "2024-02-29": "2024-02-01"}
    for last, month in cases.items():
        assert str(values(spark, calendar.latest_complete_month(day(last)))[0]) == month


def test_age_counts_completed_years(spark):
    cases = [("2014-01-01", "2025-12-31", 11), ("2014-01-01", "2026-01-01", 12), ("2014-05-10", "2026-05-09", 11), ("2014-05-10", "2026-05-10", 12), ("2012-02-29", "2024-02-29", 12)]
    for birth, at, age in cases:
        assert values(spark, calendar.age_in_years(day(birth), day(at))) == (age,)


def test_dates_from_text(spark):
    assert str(values(spark, calendar.parse_date(F.lit("2026-02-28")))[0]) == "2026-02-28"
    assert values(spark, calendar.parse_date(F.lit("28/02/2026"), strict=False)) == (None,)
    with pytest.raises(PySparkException):
        values(spark, calendar.parse_date(F.lit("28/02/2026")))


def test_codes_and_flags(spark):
    frame = spark.createDataFrame([("Y",), ("N",), ("x",), (None,)], "c string")
    rows = frame.select(
        coding.decode_flag("c"), coding.encode_flag(coding.decode_flag("c")), coding.map_values("c", {"Y": 1, "N": 2}, 0)
    ).collect()
    assert [tuple(r) for r in rows] == [(True, "Y", 1), (False, "N", 2), (False, "N", 0), (None, "N", 0)]


def test_shares_round_halves_away_from_zero_and_are_exact(spark):
    cases = [
        ("1.01", "0.5", "0.51"), ("-1.01", "0.5", "-0.51"), ("1.03", "0.125", "0.13"), ("-0.01", "0.5", "-0.01"),
        ("-0.03", "0.5", "-0.02"), ("90071992547409.93", "0.333333", "30023967491805.79"), ("0", "0.05", "0.00"),
        ("100.00", "0.125", "12.50"),
    ]
    for amount, share, expected in cases:
        found = values(spark, coding.share_of(coding.money(F.lit(amount)), coding.rate(F.lit(share))))[0]
        wanted = (Decimal(amount) * Decimal(share)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert found == wanted == Decimal(expected)
    assert values(spark, coding.money(F.lit(63058.350000000006))) == (Decimal("63058.35"),)
    assert values(spark, coding.rate(F.lit(0.125))) == (Decimal("0.125000"),)


def phrases_of(spark, note, rules=fixed.NOTE_RULES):
    return values(spark, evidence.supporting(F.lit(note).cast("string"), rules))[0]


def test_every_supporting_phrase_is_kept_in_order(spark):
    note = "Patient declined the patch. Counseled on quitting today! Also referred to quitline; no drugs"
    assert phrases_of(spark, note) == ["Counseled on quitting today", "Also referred to quitline"]
    assert phrases_of(spark, None) == [] and phrases_of(spark, "") == []


def test_rules_work_one_by_one(spark):
    plain = text.EvidenceRules(care="done")
    assert phrases_of(spark, "a done. b. done", plain) == ["a done", "done"]
    about = text.EvidenceRules(care="done", topic="topic", other_topic="other")
    assert phrases_of(spark, "topic. done. done. topic. other done", about) == ["done"]
    refused = text.EvidenceRules(care="done", excluded="not", refusal="^no$")
    assert phrases_of(spark, "done 1. no. not done. done 2. no way", refused) == ["done 2"]


def test_keyword_match_alone_is_not_evidence(spark):
    frame = spark.createDataFrame([(n,) for n, _ in NOTES], "t string")
    found = frame.where(text.matches("t", fixed.CANDIDATE_KEYWORDS)).count()
    assert found > sum(given for _, given in NOTES)
    assert values(spark, text.matches(F.lit("Counseled"), "counsel")) == (False,)


def test_weeks(spark):
    cases = {"2024-01-30": "2024-01-22", "2024-01-28": "2024-01-22", "2024-01-29": "2024-01-22", "2024-02-04": "2024-01-29"}
    for last, week in cases.items():
        assert str(values(spark, calendar.latest_complete_week(day(last)))[0]) == week
    assert str(values(spark, calendar.reporting_week(day("2024-01-28")))[0]) == "2024-01-22"
