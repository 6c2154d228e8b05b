"""Every query of the library over the given tables, as (spark, folder) -> DataFrame.

Two families: ``sales`` reports over the order tables, where an order is an account, and
``activity`` reports over events, conversations and customers, where a user's week is an
encounter and a turn is a note.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.calendar import age_in_years, fiscal_month, fiscal_year, format_date, parse_date
from tallymark.functions.coding import decode_flag, encode_flag, money, rate
from tallymark.functions.scopes import BOTH, NEGATED, Cue, Mention, ScopeRules
from tallymark.operators import checks, compare, conform, derive, distinct, evidence, intervals, measures, slices, terms
from tallymark.operators import gold as gold_tables
from tallymark.operators.joins import join_dimension
from tallymark.plans import activity, sales
from tallymark.sources import tables as sources
from tallymark.sources.staging import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METHOD = "md5"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SEGMENT = ["facility", "product"]
SEASON_START = 4
WINDOW_WEEKS = 2


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


# === Accounts over the order tables ======================================================

GOLD_ACCOUNT_COLUMNS = [
    "hospital_account_id",
    "patient_id",
    "primary_encounter_id",
    "discharge_date",
    "discharge_month",
    "fiscal_year",
    "fiscal_month",
    "facility",
    "service_line",
    "product",
    "patient_type",
    "financial_class_group",
    "surgical_case_flag",
    "ms_drg_weight",
    "total_charges",
    "estimated_net_revenue",
    "total_direct_cost",
    "total_indirect_cost",
    "total_actual_payment",
    "revenue_after_direct",
    "has_department",
    "has_financials",
]


def sales_extent(spark: SparkSession, folder: str) -> DataFrame:
    return compare.extent(sales.accounts(spark, folder), "discharge_date")


def needed_accounts(spark: SparkSession, folder: str, last: dt.date, comparisons) -> DataFrame:
    """Accounts that lie in a window of the comparisons."""
    return sales.accounts(
        spark, folder, compare.in_any_window(F.col("o_orderdate"), last, comparisons, "timestamp_ntz")
    )


def last_discharge(spark: SparkSession, folder: str) -> dt.date:
    return compare.last_date(sales.accounts(spark, folder), "discharge_date")


def sales_compare(spark, folder, comparison, dims=SEGMENT, chosen=measures.FINANCE, where=None):
    """A comparison whose accounts, and their lines, are cut to its windows before any join."""
    last = last_discharge(spark, folder)
    rows = sales.gold(spark, folder, needed_accounts(spark, folder, last, [comparison]))
    return compare.compare(rows, chosen, "discharge_date", last, [comparison], dims, where)


@query
def account_gold(spark, folder):
    return sales.gold(spark, folder).select(*GOLD_ACCOUNT_COLUMNS)


@query
def account_measures(spark, folder):
    return measures.evaluate(sales.gold(spark, folder), measures.FINANCE)


@query
def account_measures_by_segment(spark, folder):
    return measures.finance_view(sales.gold(spark, folder)).by(
        "fiscal_year",
        "facility",
        "product",
        "patient_type",
        where=(F.col("discharge_date") >= F.lit(dt.date(1996, 10, 1)))
        & (F.col("financial_class_group") != "5-LOW"),
    )


@query
def distinct_patients_by_segment(spark, folder):
    counted = measures.evaluate(
        sales.gold(spark, folder),
        measures.pick(measures.FINANCE, "patients", "encounters"),
        ["facility", "service_line"],
    )
    return counted.orderBy(F.desc("patients"), "service_line")


@query
def case_mix_by_status(spark, folder):
    return checks.profile(
        sales.accounts(spark, folder),
        "patient_type",
        F.count("*").alias("encounters"),
        F.count("ms_drg_weight").alias("encounters_with_weight"),
        *[m.column() for m in measures.pick(measures.FINANCE, "case_mix_index")],
        order="encounters",
    )


@query
def key_profile(spark, folder):
    keys = {
        "accounts": ("orders", "o_orderkey"),
        "departments": ("customer", "c_custkey"),
        "service lines": ("nation", "n_nationkey"),
        "facilities": ("region", "r_regionkey"),
        "account lines": ("lineitem", "l_orderkey"),
    }
    return checks.key_profile(
        {label: (sources.load(spark, folder, name), key) for label, (name, key) in keys.items()}
    )


@query
def duplicate_keys(spark, folder):
    return checks.duplicates(sources.load(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query
def duplicate_probe(spark, folder):
    """Whether any key occurs twice; the first one found answers it."""
    found = checks.duplicates(sources.load(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")
    return found.limit(1).agg((F.count("*") > 0).alias("found"))


@query
def orphans(spark, folder):
    """Keys that one table has and the other has not, both ways; each table is read once."""
    pairs = [
        ("orders", "o_orderkey", "lineitem", "l_orderkey"),
        ("documents", "doc_id", "labels", "doc_id"),
    ]
    found = []
    for left, left_key, right, right_key in pairs:
        rows = checks.presence(
            {
                left: (sources.load(spark, folder, left), [left_key]),
                right: (sources.load(spark, folder, right), [right_key]),
            }
        )
        label = F.when(F.col(right) == 0, f"{left} without {right}").when(F.col(left) == 0, f"{right} without {left}")
        found.append(
            rows.where(f"{left} = 0 or {right} = 0").select(
                label.alias("finding"), F.col(left_key).alias("key"), F.greatest(left, right).alias("row_count")
            )
        )
    return reduce(DataFrame.union, found)


@query
def gold_checks(spark, folder):
    """Uniqueness, completeness and missing partners of the account table, in one pass."""
    gold = sales.gold(spark, folder).select("hospital_account_id", "has_department", "has_financials")
    keys = checks.presence(
        {
            "accounts": (sales.accounts(spark, folder), ["hospital_account_id"]),
            "gold": (gold, ["hospital_account_id"]),
        },
        {"gold": {"no_department": ~F.col("has_department"), "no_financials": ~F.col("has_financials")}},
    )
    return checks.count_violations(
        keys,
        {
            "account twice in gold": F.col("gold") > 1,
            "account not in gold": (F.col("accounts") > 0) & (F.col("gold") == 0),
            "gold without account": (F.col("accounts") == 0) & (F.col("gold") > 0),
            "account without department": F.col("no_department") > 0,
            "account without financials": F.col("no_financials") > 0,
        },
    )


@query
def activity_gold_checks(spark, folder):
    """The user-week table has each encounter once, and all of them."""
    keys = checks.presence(
        {
            "encounters": (activity.encounters(spark, folder), ["patient_id", activity.PERIOD]),
            "gold": (activity.gold(spark, folder), ["patient_id", activity.PERIOD]),
        }
    )
    return checks.count_violations(
        keys,
        {
            "user-week twice in gold": F.col("gold") > 1,
            "user-week not in gold": F.col("gold") == 0,
            "gold without user-week": F.col("encounters") == 0,
        },
    )


@query
def star_join(spark, folder):
    """Accounts with the line that is numbered as their first, matched on both ids, and all
    other partners; lines of the account with another number do not match."""
    rows = sales.accounts(spark, folder).withColumn("primary_encounter_id", F.lit(1).cast("long"))
    gold = gold_tables.account(
        rows,
        sales.departments(spark, folder),
        sales.financials(spark, folder),
        sales.primary_lines(spark, folder),
    )
    return gold.select(
        "hospital_account_id", "facility", "first_shipped", "quantity", "estimated_net_revenue",
        "has_department", "has_encounter", "has_financials",
    )


@query
def join_grain(spark, folder):
    return checks.join_grain(
        sources.load(spark, folder, "orders"), sources.load(spark, folder, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query
def conversation_grain(spark, folder):
    turns = sources.load(spark, folder, "conversations")
    openings = turns.where(F.col("turn") == 0)
    return checks.join_grain(openings, turns, "conv_id", "conv_id")


@query
def reconcile_totals(spark, folder):
    accounts, financials = sales.accounts(spark, folder), sales.financials(spark, folder)
    return checks.reconcile(
        {
            "accounts": (accounts, {"charges": ("total_charges", "total_charges")}),
            "financials": (financials, {"revenue": ("estimated_net_revenue", "estimated_net_revenue")}),
        },
        sales.gold(spark, folder),
    )


@query
def category_profile(spark, folder):
    return checks.profile(
        sources.load(spark, folder, "orders"),
        "o_orderpriority",
        F.count("*").alias("orders"),
        F.count_if(F.col("o_totalprice") >= 250_000).alias("large_orders"),
        F.count(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("with_price"),
        F.round(
            F.try_divide(
                F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)"))).cast(
                    "double"
                ),
                F.count_if(F.col("o_orderstatus") == "F"),
            ),
            2,
        ).alias("average_price"),
        order="orders",
    )


@query
def manifest(spark, folder):
    return sources.manifest({name: sources.row_counter(spark, folder, name) for name in TABLES})


@query
def date_extent(spark, folder):
    return sales_extent(spark, folder).select("first_date", "last_date", "last_month")


@query
def latest_complete_month(spark, folder):
    return sales_extent(spark, folder).select(
        "last_date", "latest_complete_month", F.last_day("latest_complete_month").alias("latest_complete_day")
    )


@query
def mom_change(spark, folder):
    return sales_compare(spark, folder, compare.month_over_month())


@query
def yoy_change(spark, folder):
    return sales_compare(spark, folder, compare.year_over_year())


@query
def mtd_matched_days(spark, folder):
    return sales_compare(spark, folder, compare.month_to_date())


@query
def season_changes(spark, folder):
    return sales_compare(
        spark, folder, compare.season(SEASON_START), ["facility", "service_line", "product"]
    )


@query
def season_matched(spark, folder):
    day = F.col("discharge_date")
    chosen = (
        sales.located_accounts(spark, folder)
        .where(F.col("facility") == "ASIA")
        .where((day >= F.lit(dt.date(1999, 4, 1))) & (day < F.lit(dt.date(2000, 9, 1))))
        .where(F.month(day).between(4, 8))
    )
    return (
        chosen.groupBy(
            F.year(day).alias("discharge_year"), F.month(day).alias("discharge_month"), "service_line", "product"
        )
        .agg(F.count("*").alias("encounters"))
        .orderBy("discharge_month", "discharge_year", "service_line", "product")
    )


@query
def monthly_trend(spark, folder):
    return compare.trend(
        sales.gold(spark, folder), measures.FINANCE, "discharge_month", last=sales_extent(spark, folder)
    )


@query
def segment_contribution(spark, folder):
    dims = ["facility", "product"]
    changes = sales_compare(
        spark,
        folder,
        compare.season(SEASON_START),
        dims,
        [measures.count_rows("accounts")],
        where=F.col("patient_type") == "Inpatient",
    )
    return compare.contribution(changes, "accounts", dims)


@query
def segment_financial_change(spark, folder):
    return sales_compare(
        spark,
        folder,
        compare.season(SEASON_START),
        SEGMENT,
        [
            measures.count_rows("accounts"),
            *measures.pick(measures.FINANCE, "net_revenue", "revenue_after_direct"),
        ],
        where=(F.col("patient_type") == "Inpatient") & (F.col("facility") == "EUROPE"),
    )


@query
def expected_trend(spark, folder):
    return checks.expected_trend(
        sales.located_accounts(spark, folder),
        "discharge_date",
        2000,
        (4, 8),
        (F.col("facility") == "AMERICA") & (F.col("product") == "BUILDING"),
    )


@query
def fiscal_periods(spark, folder):
    day = F.col("discharge_date")
    return (
        sales.accounts(spark, folder)
        .groupBy(fiscal_year(day).alias("fiscal_year"), fiscal_month(day).alias("fiscal_month"))
        .agg(
            F.count("*").alias("accounts"),
            F.min(day).alias("first_date"),
            F.max(day).alias("last_date"),
        )
    )


@query
def headline(spark, folder):
    last = last_discharge(spark, folder)
    month = [compare.month_over_month("latest complete month")]
    rows = sales.gold(spark, folder, needed_accounts(spark, folder, last, month))
    placed = compare.in_windows(rows, "discharge_date", last, month)
    return measures.evaluate(
        placed,
        measures.FINANCE,
        [F.col("comparison").alias("period"), F.col("current_period").alias("dates"), "data_until"],
        where=F.col("side") == "current",
    )


# === Steps over given rows ===============================================================


@query
def returned_lines(spark, folder):
    """Codes to flags and back: returned and open lines."""
    lines = sources.load(spark, folder, "lineitem").select(
        "l_returnflag",
        decode_flag("l_returnflag", "R").alias("returned"),
        decode_flag("l_linestatus", "O").alias("open"),
        "l_quantity",
    )
    flagged = lines.withColumn("returned_code", encode_flag("returned"))
    return flagged.groupBy("l_returnflag", "returned", "open", "returned_code").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)").alias("quantity")
    )


@query
def dates_as_text(spark, folder):
    """Ship dates written as text in one form and read again: every row must come back."""
    day = F.col("l_shipdate").cast("date")
    text = format_date(day, "dd/MM/yyyy")
    read = parse_date(text, "dd/MM/yyyy", strict=False)
    lines = sources.load(spark, folder, "lineitem").select(
        F.substring(text, 4, 7).alias("month_text"), read.alias("read"), day.alias("day")
    )
    return lines.groupBy("month_text").agg(
        F.count("*").alias("lines"), F.count_if(F.col("read") == F.col("day")).alias("same"), F.min("read").alias("first_day")
    )


@query
def account_age(spark, folder):
    """Accounts by completed years between the order and the last order of all."""
    last = sales_extent(spark, folder).select("last_date").scalar()
    years = age_in_years("discharge_date", last)
    return (
        sales.accounts(spark, folder)
        .groupBy(years.alias("years"))
        .agg(F.count("*").alias("accounts"), F.max("discharge_date").alias("youngest"))
    )


@query
def split_entities(spark, folder):
    """One wide base split into its entities, each profiled."""
    base = sales.accounts(spark, folder)
    parts = conform.split(
        base,
        {
            "accounts": {"id": "hospital_account_id", "amount": "total_charges"},
            "patients": {"id": "patient_id", "amount": "total_charges"},
            "encounters": {"id": "primary_encounter_id", "amount": "ms_drg_weight"},
        },
    )
    lines = [
        frame.agg(
            F.count("*").alias("rows"),
            F.countDistinct("id").alias("distinct_keys"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(38,2)").alias("amount"),
        ).select(F.lit(name).alias("entity"), "*")
        for name, frame in parts.items()
    ]
    return reduce(DataFrame.union, lines)


@query
def urgent_members(spark, folder):
    """Membership, and all rows outside of a segment that two conditions make."""
    rows = sales.accounts(spark, folder)
    chosen = rows.where(F.col("financial_class_group").isin("1-URGENT", "2-HIGH"))
    kept = derive.outside(chosen, (F.col("patient_type") == "Inpatient") & F.col("surgical_case_flag"))
    return kept.groupBy("patient_type", "financial_class_group").agg(
        F.count("*").alias("accounts"), F.sum("total_charges").cast("decimal(38,2)").alias("charges")
    )


@query
def keyed_sample(spark, folder):
    """About a tenth of the accounts, the same on every run, with their columns."""
    chosen = derive.keyed_sample(sales.accounts(spark, folder), "sample", ["hospital_account_id"], 0.1, method="md5")
    return chosen.select("hospital_account_id", "patient_id", "discharge_date", "patient_type", "total_charges")


@query
def customer_months(spark, folder):
    """Every customer in each of three months, with or without orders."""
    customers = sources.load(spark, folder, "customer").select(F.col("c_custkey").alias("patient_id"), "c_mktsegment")
    panel = derive.month_panel(customers, dt.date(1999, 1, 1), 3)
    day = F.col("o_orderdate")
    orders = sales.accounts(
        spark, folder, (day >= F.lit("1999-01-01").cast("timestamp_ntz")) & (day < F.lit("1999-04-01").cast("timestamp_ntz"))
    )
    counts = orders.groupBy("patient_id", F.trunc("discharge_date", "month").alias("reporting_month")).agg(
        F.count("*").alias("orders")
    )
    joined = panel.join(counts, ["patient_id", "reporting_month"], "left")
    return joined.groupBy("c_mktsegment", "reporting_month").agg(
        F.count("*").alias("customers"),
        F.count("orders").alias("with_orders"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
    )


@query
def daily_spine(spark, folder):
    """Events of each of the first 40 days of the year; days without any are shown too."""
    days = sources.spine(spark, 40, "day_number").withColumn("day", F.expr("date_add(DATE '2024-01-01', CAST(day_number AS INT))"))
    counts = (
        sources.load(spark, folder, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))
    )
    joined = days.join(counts, "day", "left")
    return joined.select("day", *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in ("events", "users")])


EVENT_LABELS = [("view", "looked"), ("click", "looked"), ("signup", "joined"), ("purchase", "bought")]


@query
def inline_labels(spark, folder):
    """Events by the label of a literal dimension; types that it lacks have none."""
    labels = sources.inline_table(spark, EVENT_LABELS, "event_type STRING, label STRING")
    joined = join_dimension(sources.load(spark, folder, "events"), labels, "event_type", "left")
    return joined.groupBy("label").agg(
        F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("value")
    )


# === Text evidence =======================================================================


@query
def keyword_candidates(spark, folder):
    found = evidence.keyword_candidates(
        sources.load(spark, folder, "documents"),
        sources.load(spark, folder, "labels"),
        on="doc_id",
        text="text",
        pattern="licen[sc]e|copyright|[Rr]eserved|@",
        parent_filter=F.col("toxic") == 0,
    )
    return found.select("doc_id", "lang", "source", "quality", "n_chars")


LICENCE_RULES = evidence.EvidenceRules(
    care=r"([Ll]icensed|[Rr]eleased) under ",
    excluded=r"CC BY-NC",
    refusal=r"^All rights reserved$",
)


@query
def licence_grants(spark, folder):
    """Every clause in which a document grants a licence for any use."""
    labelled = evidence.label_notes(sources.load(spark, folder, "documents"), LICENCE_RULES, "text")
    return evidence.phrase_rows(labelled, "doc_id", "source")


@query
def licence_grants_by_source(spark, folder):
    """Documents collapsed to their source: how many grant a licence, and the first of them."""
    labelled = evidence.label_notes(sources.load(spark, folder, "documents"), LICENCE_RULES, "text")
    return evidence.evidence_per_parent(labelled, "source", "doc_id")


def labelled_notes(spark, folder):
    return evidence.label_notes(activity.notes(spark, folder), activity.TURN_RULES)


@query
def note_labels(spark, folder):
    return labelled_notes(spark, folder).select("note_id", "encounter_id", "note_type", "n_phrases", "label")


@query
def note_phrases(spark, folder):
    """The review table: every supporting phrase with its note and place."""
    return evidence.phrase_rows(labelled_notes(spark, folder), "note_id", "encounter_id")


@query
def evidence_per_encounter(spark, folder):
    return evidence.evidence_per_parent(labelled_notes(spark, folder))


@query
def note_gap_candidates(spark, folder):
    """Turns that mention a word, of encounters with a gap in the structured data."""
    gap = (
        (F.col("age_at_encounter") >= gold_tables.ELIGIBLE_AGE)
        & (F.col("tobacco_screen_status") == gold_tables.CURRENT_USER)
        & ~F.col("structured_cessation_intervention")
    )
    found = evidence.keyword_candidates(
        activity.notes(spark, folder).drop("patient_id"),
        activity.encounters(spark, folder),
        on="encounter_id",
        text="note_text",
        pattern=activity.TURN_RULES.care,
        parent_filter=gap,
    )
    return found.select("encounter_id", "patient_id", activity.PERIOD, "note_id", "note_text")


@query
def representative_text(spark, folder):
    return evidence.representative(sources.load(spark, folder, "documents"), "doc_id", "text")


CONTRAST_LINES = [
    ("Licensed under the Apache License, Version 2.0.", "provided"),
    ("Released under the MIT License.", "provided"),
    ("Licensed under CC BY-NC 4.0.", "not_provided"),
    ("All rights reserved.", "not_provided"),
]


@query
def contrast_sample(spark, folder):
    """One document of each chosen licence line, with its label and the expected one."""
    lines = document_lines(spark, folder)
    found = evidence.contrast_sample(lines, [line for line, _ in CONTRAST_LINES], LICENCE_RULES, "doc_id", "line")
    expected = sources.inline_table(spark, CONTRAST_LINES, "line STRING, expected STRING")
    return join_dimension(found, expected, "line").select("doc_id", "line", "label", "expected").orderBy("doc_id", "line")


def document_lines(spark, folder):
    return sources.load(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


# A grant, unless something in its clause or before it takes it back.
LICENCE_SCOPES = ScopeRules(
    mentions=(Mention("grant", r"\b(?:licensed|released) under\b"),),
    cues=(Cue(r"\bcc by-nc\b", NEGATED, BOTH), Cue(r"\b(?:not|never)\b", NEGATED)),
    refusal=r"^\s*all rights reserved\s*$",
    boundary=r"(?<!\d)[.]|[.](?!\d)|[;!?\n]+",
)
# Lines of known standing, by hand: whether each grants a licence for any use. The last one is
# in no document.
KNOWN_LINES = [
    ("Licensed under the Apache License, Version 2.0.", True),
    ("Released under the MIT License.", True),
    ("This work is licensed under the GNU General Public License, version 3.", True),
    ("Licensed under CC BY-NC 4.0.", False),
    ("All rights reserved.", False),
    ("Of.", False),
    ("The.", False),
    ("To whom it may concern: used by permission.", False),
]


def judged_lines(spark, folder):
    known = sources.inline_table(spark, KNOWN_LINES, "line STRING, expected BOOLEAN")
    return evidence.known_texts(document_lines(spark, folder), known, LICENCE_SCOPES, "line")


@query
def known_texts(spark, folder):
    """Lines of known standing as they stand in the documents, against the rules."""
    return judged_lines(spark, folder)


@query
def known_text_agreement(spark, folder):
    """Confusion counts over the rows that hold those lines."""
    return checks.agreement(judged_lines(spark, folder), "expected", "provided", "rows")


@query
def note_scopes(spark, folder):
    """Mentions of every note by the scopes that they stand in."""
    found = evidence.mentions(activity.notes(spark, folder), activity.TURN_SCOPES, "note_id")
    free = ~(F.col("negated") | F.col("past") | F.col("other") | F.col("planned") | F.col("offered"))
    return found.groupBy("note_id").agg(
        F.count("*").alias("mentions"),
        *[F.count_if(name).alias(name) for name in ("about", "taken", "negated", "past", "planned")],
        F.count_if(free).alias("affirmed"),
        F.count_if(free & F.col("about") & ~F.col("taken")).alias("supporting"),
    )


@query
def scoped_note_labels(spark, folder):
    """Every note's label by scopes, beside its label by clause patterns."""
    by_scope = evidence.label_notes(activity.notes(spark, folder), activity.TURN_SCOPES)
    both = by_scope.select("note_id", "note_text", F.col("label").alias("by_scope"))
    by_clause = evidence.label_notes(both, activity.TURN_RULES)
    return by_clause.groupBy("by_scope", F.col("label").alias("by_clause")).agg(F.count("*").alias("notes"))


@query
def term_candidates(spark, folder):
    """Documents with a phrase of three words of the benchmark, and how often: thousands of
    phrases, found by the index."""
    texts = sources.load(spark, folder, "benchmark").select(terms.words("text").alias("words")).where(F.size("words") >= 3)
    places = texts.select("words", F.explode(F.sequence(F.lit(1), F.size("words") - 2)).alias("at"))
    phrases = places.select(F.array_join(F.slice("words", F.col("at"), F.lit(3)), " ").alias("term")).distinct()
    indexed = terms.index(sources.load(spark, folder, "documents"), "doc_id", "text")
    indexed = written(indexed, "word-index", compression="zstd")
    found = terms.occurrences(indexed, phrases, "doc_id", "term")
    return found.groupBy("doc_id", "term").agg(F.count("*").alias("times"))


# === User-weeks and their measures ========================================================


@query
def patient_period_gold(spark, folder):
    return activity.gold(spark, folder)


@query
def quality_rates(spark, folder):
    return measures.evaluate(activity.gold(spark, folder), measures.CLINICAL)


@query
def quality_rates_by_cohort(spark, folder):
    return measures.clinical_view(activity.gold(spark, folder), activity.PERIOD).by(
        "clinic", "has_copd", "has_diabetes", "transportation_barrier"
    )


def activity_extent(spark, folder):
    return compare.extent(activity.encounters(spark, folder), "encounter_date")


@query
def quality_trend(spark, folder):
    return compare.trend(
        activity.gold(spark, folder),
        measures.CLINICAL,
        activity.PERIOD,
        ["clinic"],
        last=activity_extent(spark, folder),
        period_end=lambda week: F.date_add(week, 6),
    )


@query
def care_gaps(spark, folder):
    return measures.evaluate(
        activity.gold(spark, folder),
        measures.pick(measures.CLINICAL, "care_gaps", "cessation_den"),
        [activity.PERIOD, "clinic", "housing_instability", "food_insecurity"],
        where=F.col("transportation_barrier"),
    )


@query
def num_le_den(spark, folder):
    pairs = {name: (f"{name}_num", f"{name}_den") for name in ("screening", "cessation", "combined")}
    return checks.numerators_within(activity.gold(spark, folder), pairs, ["clinic"])


def activity_compare(spark, folder, comparison, dims=(), chosen=measures.CLINICAL):
    """A comparison of weeks whose events are cut to its windows where they are read, and
    whose notes to those weeks."""
    days = sources.load(spark, folder, "events").select(F.col("ts").cast("date").alias("day"))
    last = compare.last_date(days, "day")
    weeks = compare.in_any_window(F.col("ts"), last, [comparison], "timestamp_ntz")
    return compare.compare(activity.gold(spark, folder, weeks), chosen, activity.PERIOD, last, [comparison], dims)


@query
def rate_point_change(spark, folder):
    return activity_compare(spark, folder, compare.latest_weeks(1, "latest_week"))


@query
def two_week_compare(spark, folder):
    return activity_compare(spark, folder, compare.latest_weeks(WINDOW_WEEKS, "two_weeks"), ["clinic"])


@query
def gap_contribution(spark, folder):
    dims = ["clinic", "transportation_barrier"]
    changes = activity_compare(
        spark, folder, compare.latest_weeks(WINDOW_WEEKS, "two_weeks"), dims, measures.pick(measures.CLINICAL, "care_gaps")
    )
    return compare.contribution(changes, "care_gaps", dims)


@query
def rate_contribution(spark, folder):
    """Which clinics and groups account for the change of the cessation rate, in points."""
    dims = ["clinic", "transportation_barrier"]
    changes = activity_compare(
        spark,
        folder,
        compare.latest_weeks(WINDOW_WEEKS, "two_weeks"),
        dims,
        measures.rate("cessation", "cessation_num", "cessation_den"),
    )
    return compare.rate_contribution(changes, "cessation", dims)


@query
def attributes_left_join(spark, folder):
    labels = sources.load(spark, folder, "labels")
    documents = sources.load(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    joined = join_dimension(documents, labels, "doc_id", how="left")
    return joined.groupBy("lang", "quality", "toxic").agg(
        F.count("*").alias("documents"), F.sum("n_chars").cast("long").alias("characters")
    )


@query
def encounter_preview(spark, folder):
    return conform.preview(
        activity.encounters(spark, folder),
        [
            "encounter_id",
            "patient_id",
            activity.PERIOD,
            "clinic",
            "age_at_encounter",
            "tobacco_screen_status",
            "structured_cessation_intervention",
            "has_copd",
            "has_diabetes",
        ],
        ["encounter_id"],
        10,
    )


@query
def status_profile(spark, folder):
    return checks.profile(
        activity.encounters(spark, folder),
        "tobacco_screen_status",
        F.count("*").alias("encounters"),
        F.count_if(F.col("age_at_encounter") >= gold_tables.ELIGIBLE_AGE).alias("eligible"),
        order="encounters",
    )


@query
def assessment_preview(spark, folder):
    return conform.preview(
        activity.assessments(spark, folder),
        ["patient_id", "transportation_barrier", "housing_instability", "food_insecurity"],
        [F.desc("transportation_barrier"), "patient_id"],
        10,
    )


@query
def note_join_grain(spark, folder):
    return checks.join_grain(
        activity.encounters(spark, folder), activity.notes(spark, folder), "encounter_id", "encounter_id"
    )


@query
def assessment_grain(spark, folder):
    rows = activity.assessments(spark, folder)
    return rows.agg(F.count("*").alias("assessment_rows"), F.countDistinct("patient_id").alias("distinct_patients"))


# === Several levels, windows and slices at once ==============================================


@query
def account_levels(spark, folder):
    """All account measures overall, by facility and by product, from one pass."""
    levels = {"overview": [], "facility": ["facility"], "product": ["facility", "product"]}
    return measures.evaluate_levels(sales.gold(spark, folder), measures.FINANCE, levels)


@query
def distinct_rollups(spark, folder):
    """Patients overall, by month and by segment, from bitmaps that are made once."""
    rows = sales.located_accounts(spark, folder).withColumn("discharge_month", F.trunc("discharge_date", "month"))
    counts = {"patients": ("patient_id", None), "surgical_patients": ("patient_id", "surgical_case_flag")}
    made = written(distinct.bitmaps(rows, ["discharge_month", "facility", "product"], counts), "patient-bitmaps")
    levels = {"overall": [], "month": ["discharge_month"], "segment": ["facility", "product"]}
    return reduce(
        lambda one, two: one.unionByName(two, allowMissingColumns=True),
        [distinct.merged(made, dims, list(counts)).withColumn("level", F.lit(name)) for name, dims in reversed(levels.items())],
    )


@query
def rolling_windows(spark, folder):
    """Accounts and charges of the 7, 28 and 91 days up to every Sunday: 1,035 windows that
    overlap, as a table."""
    sundays = sources.spine(spark, 345, "week").withColumn("last_day", F.expr("date_add(DATE '1995-01-01', CAST(7 * week AS INT))"))
    windows = sundays.select("last_day", F.explode(F.array(F.lit(7), F.lit(28), F.lit(91))).alias("days")).withColumn(
        "first_day", F.date_sub("last_day", F.col("days") - 1)
    )
    placed = intervals.in_window_table(sales.accounts(spark, folder), "discharge_date", windows)
    chosen = [measures.count_rows("accounts"), measures.total("charges", "total_charges")]
    return measures.evaluate(placed, chosen, ["last_day", "days"])


@query
def dense_trend(spark, folder):
    """Surgical cases of Asian service lines in every month, months without any included."""
    rows = sales.located_accounts(spark, folder).withColumn("discharge_month", F.trunc("discharge_date", "month"))
    chosen = [measures.count_rows("accounts"), *measures.pick(measures.FINANCE, "patients", "case_mix_index")]
    surgical = (F.col("facility") == "ASIA") & F.col("surgical_case_flag")
    return compare.dense_trend(rows, chosen, "discharge_month", ["service_line"], "1 month", surgical)


SLICE_DIMS = ["clinic", "transportation_barrier", "has_copd", "has_diabetes"]


@query
def rate_slices(spark, folder):
    """The slices, over all levels of four dimensions, in which the cessation rate changed."""
    cessation = measures.rate("cessation", "cessation_num", "cessation_den")
    changes = activity_compare(spark, folder, compare.latest_weeks(WINDOW_WEEKS, "two_weeks"), SLICE_DIMS, cessation)
    return slices.rate_slices(changes, "cessation", SLICE_DIMS, 0.02)


@query
def row_reconciliation(spark, folder):
    """Accounts whose revenue, rounded once, is not what the gold table has from rounded lines."""
    price, discount = money("l_extendedprice"), rate("l_discount")
    lines = sources.load(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("hospital_account_id")).agg(
        F.round(F.sum(price * (1 - discount)), 2).cast("decimal(18,2)").alias("estimated_net_revenue")
    )
    accounts = sales.accounts(spark, folder).select("hospital_account_id", "patient_id")
    source = accounts.join(lines, "hospital_account_id", "left")
    found = checks.reconcile_rows(
        source, sales.gold(spark, folder), ["hospital_account_id"], ["patient_id", "estimated_net_revenue"]
    )
    return found.withColumn("differs", F.concat_ws(",", "differs"))


@query
def refreshed_accounts(spark, folder):
    """A table refreshed in full, checked before it is published, and read by its name."""
    table = f"tallymark_accounts_{uuid.uuid4().hex[:12]}"
    rows = sales.accounts(spark, folder).select("hospital_account_id", "patient_type", "total_charges")

    def unique(staged: DataFrame) -> None:
        checks.require_empty(checks.duplicates(staged, "hospital_account_id"), "an account occurs twice")

    sources.write_full(rows.where("patient_type = 'Inpatient'"), table)
    sources.write_full(rows, table, check=unique)
    return sources.scan(spark, table).groupBy("patient_type").agg(
        F.count("*").alias("accounts"), F.sum("total_charges").cast("decimal(38,2)").alias("charges")
    )


# === Scan and sort forms ====================================================================


@query
def preview_ordered(spark, folder):
    return conform.preview(
        sources.load(spark, folder, "orders"),
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
        ["o_orderkey"],
        10,
    )


@query
def mixed_order_topk(spark, folder):
    chosen = sources.load(spark, folder, "customer").withColumn("in_credit", F.col("c_acctbal") > 0)
    return conform.preview(
        chosen, ["c_custkey", "c_mktsegment", "in_credit"], [F.desc("in_credit"), "c_custkey"], 10
    )


@query
def param_scan(spark, folder):
    """SQL over a table named by a parameter."""
    sources.load(spark, folder, "orders").createOrReplaceTempView("tallymark_orders")
    found = sources.query_table(
        spark,
        """
        SELECT o_orderpriority, COUNT(*) AS orders, COUNT(DISTINCT o_custkey) AS customers
        FROM IDENTIFIER(:prefix || '_orders')
        GROUP BY ALL
        ORDER BY orders DESC, o_orderpriority
        """,
        prefix="tallymark",
    )
    spark.catalog.dropTempView("tallymark_orders")  # the frame is resolved; views show up in every schema
    return found
