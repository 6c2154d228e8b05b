"""The same results in ANSI SQL, written against the tables and not against the library.

Each text runs in an engine of its own, with the tables as views. Shared parts are common
table expressions put before the body of a query.
"""

from __future__ import annotations

from tallymark.plans.queries import TABLES


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def months_later(day: str, count: int | str) -> str:
    return f"CAST({day} + INTERVAL ({count}) MONTH AS DATE)"


def fiscal(day: str) -> str:
    shifted = months_later(month(day), 3)
    return (
        f"CAST(year({shifted}) AS INTEGER) AS fiscal_year, CAST(month({shifted}) AS INTEGER) AS fiscal_month"
    )


def with_parts(parts: str, body: str) -> str:
    return f"WITH {parts.strip().rstrip(',')}\n{body}"


# === Accounts over the order tables ======================================================

SALES = f"""
accounts AS (
  SELECT o_orderkey AS hospital_account_id, o_custkey AS patient_id, o_orderkey AS primary_encounter_id,
         o_custkey AS discharge_department_id, CAST(o_orderdate AS DATE) AS discharge_date,
         CASE o_orderstatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient' ELSE 'Observation' END AS patient_type,
         o_orderpriority AS financial_class_group,
         o_orderpriority = '1-URGENT' AS surgical_case_flag,
         CASE WHEN o_orderstatus = 'F'
              THEN CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.00001 AS DECIMAL(6,5)), 2) AS DOUBLE)
         END AS ms_drg_weight,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_charges
  FROM orders
),
departments AS (
  SELECT c_custkey AS department_id, r_name AS facility, n_name AS service_line, c_mktsegment AS product
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
line_amounts AS (
  SELECT l_orderkey,
         round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(10,6))), 2) AS net,
         round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(10,6)), 2) AS direct,
         round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(10,6)), 2) AS indirect,
         CAST(l_tax AS DECIMAL(10,6)) AS tax
  FROM lineitem
),
financials AS (
  SELECT l_orderkey AS hospital_account_id,
         CAST(sum(net) AS DECIMAL(18,2)) AS estimated_net_revenue,
         CAST(sum(direct) AS DECIMAL(18,2)) AS total_direct_cost,
         CAST(sum(indirect) AS DECIMAL(18,2)) AS total_indirect_cost,
         CAST(sum(round(CAST(net AS DECIMAL(18,2)) * (1 + tax), 2)) AS DECIMAL(18,2)) AS total_actual_payment
  FROM line_amounts GROUP BY l_orderkey
),
gold AS (
  SELECT a.*, d.facility, d.service_line, d.product, {month('a.discharge_date')} AS discharge_month,
         {fiscal('a.discharge_date')},
         f.estimated_net_revenue, f.total_direct_cost, f.total_indirect_cost, f.total_actual_payment,
         f.estimated_net_revenue - f.total_direct_cost AS revenue_after_direct,
         d.department_id IS NOT NULL AS has_department, f.hospital_account_id IS NOT NULL AS has_financials
  FROM accounts a
  LEFT JOIN departments d ON a.discharge_department_id = d.department_id
  LEFT JOIN financials f ON a.hospital_account_id = f.hospital_account_id
),
extent AS (
  SELECT min(discharge_date) AS first_date, max(discharge_date) AS last_date,
         {month('max(discharge_date)')} AS last_month,
         CASE WHEN max(discharge_date) = last_day(max(discharge_date)) THEN {month('max(discharge_date)')}
              ELSE {months_later(month('max(discharge_date)'), -1)} END AS latest_complete_month
  FROM accounts
),
"""

FINANCE = {
    "patients": "count(DISTINCT patient_id)",
    "encounters": "count(DISTINCT primary_encounter_id)",
    "surgical_cases": "count(DISTINCT CASE WHEN surgical_case_flag THEN primary_encounter_id END)",
    "case_mix_index": (
        "round(CAST(sum(CASE WHEN patient_type = 'Inpatient' THEN CAST(ms_drg_weight AS DECIMAL(18,4)) END) AS DOUBLE)"
        " / nullif(count(CASE WHEN patient_type = 'Inpatient' THEN ms_drg_weight END), 0), 6)"
    ),
    "net_revenue": "CAST(sum(estimated_net_revenue) AS DECIMAL(38,2))",
    "direct_cost": "CAST(sum(total_direct_cost) AS DECIMAL(38,2))",
    "indirect_cost": "CAST(sum(total_indirect_cost) AS DECIMAL(38,2))",
    "revenue_after_direct": "CAST(sum(revenue_after_direct) AS DECIMAL(38,2))",
    "accounts": "count(*)",
}
FINANCE_NAMES = [name for name in FINANCE if name != "accounts"]


def rate_sql(name: str) -> dict[str, str]:
    return {
        f"{name}_num": f"CAST(coalesce(sum({name}_num), 0) AS BIGINT)",
        f"{name}_den": f"CAST(coalesce(sum({name}_den), 0) AS BIGINT)",
        f"{name}_rate": (
            f"round(CAST(sum({name}_num) AS DOUBLE) / nullif(CAST(sum({name}_den) AS DOUBLE), 0), 6)"
        ),
    }


CLINICAL = {
    **rate_sql("screening"),
    **rate_sql("cessation"),
    **rate_sql("combined"),
    "care_gaps": "CAST(coalesce(sum(care_gap), 0) AS BIGINT)",
}


def measured(names, known) -> str:
    return ",\n       ".join(f"{known[name]} AS {name}" for name in names)


def evaluate_sql(names, known, dims=(), where="TRUE", source="gold", order="") -> str:
    head = "".join(f"{dim}, " for dim in dims)
    group = f"GROUP BY {', '.join(dims)}" if dims else ""
    return f"SELECT {head}{measured(names, known)}\nFROM {source}\nWHERE {where}\n{group}\n{order}"


# Windows by comparison: current start, current end, prior start, prior end, over ``extent``.
LCM = "latest_complete_month"
SEASON_FIRST = months_later(LCM, f"-((month({LCM}) - 4 + 12) % 12)")
BOUNDS = {
    "mom": (LCM, f"last_day({LCM})", months_later(LCM, -1), f"last_day({months_later(LCM, -1)})"),
    "yoy": (LCM, f"last_day({LCM})", months_later(LCM, -12), f"last_day({months_later(LCM, -12)})"),
    "mtd": ("last_month", "last_date", months_later("last_month", -12), months_later("last_date", -12)),
    "season": (
        SEASON_FIRST,
        f"last_day({LCM})",
        months_later(SEASON_FIRST, -12),
        f"last_day({months_later(LCM, -12)})",
    ),
    "latest_week": ("week", "week + 6", "week - 7", "week - 1"),
    "two_weeks": ("week - 7", "week + 6", "week - 21", "week - 8"),
}


def periods_sql(comparisons) -> str:
    rows = "\n  UNION ALL\n  ".join(
        f"SELECT '{name}' AS comparison, {a} AS cs, {b} AS ce, {c} AS ps, {d} AS pe FROM extent"
        for name, (a, b, c, d) in ((name, BOUNDS[name]) for name in comparisons)
    )
    return f"""
bounds AS (
  {rows}
),
periods AS (
  SELECT *, CAST(cs AS VARCHAR) || '..' || CAST(ce AS VARCHAR) AS current_period,
         CAST(ps AS VARCHAR) || '..' || CAST(pe AS VARCHAR) AS prior_period,
         (SELECT CAST(last_date AS VARCHAR) FROM extent) AS data_until
  FROM bounds
),
"""


def side_sql(side: str, names, known, dims, day, where) -> str:
    start, end = ("cs", "ce") if side == "current" else ("ps", "pe")
    keys = "".join(f", {dim}" for dim in dims)
    return f"""
{side}_side AS (
  SELECT comparison{keys},
       {measured(names, known)}
  FROM (SELECT p.comparison, p.{start} AS w_start, p.{end} AS w_end, g.* FROM periods p JOIN gold g
        ON g.{day} BETWEEN p.{start} AND p.{end})
  WHERE {where}
  GROUP BY comparison{keys}
),
"""


RATES = {"screening_rate", "cessation_rate", "combined_rate"}
AVERAGES = {"case_mix_index"}


def change_sql(name: str) -> str:
    now, then = f"c.{name}", f"p.{name}"
    if name not in RATES | AVERAGES:
        now, then = f"coalesce({now}, 0)", f"coalesce({then}, 0)"
    if name in RATES:
        return (
            f"{now} AS {name}, {then} AS {name}_prior, "
            f"round(({now} - {then}) * CAST(100 AS DOUBLE), 4) AS {name}_points"
        )
    change = f"({now} - {then})"
    if name in AVERAGES:
        change = f"round({change}, 6)"
    return (
        f"{now} AS {name}, {then} AS {name}_prior, {change} AS {name}_change, "
        f"round(CAST({change} AS DOUBLE) * CAST(100 AS DOUBLE) / nullif(CAST({then} AS DOUBLE), 0), 4)"
        f" AS {name}_percent"
    )


def compare_parts(parts, comparisons, names, known, dims, day, where="TRUE") -> str:
    """CTEs up to ``changes``: both sides of each comparison, joined group by group."""
    same = " AND ".join(f"c.{dim} IS NOT DISTINCT FROM p.{dim}" for dim in ("comparison", *dims))
    keys = ", ".join(f"coalesce(c.{dim}, p.{dim}) AS {dim}" for dim in ("comparison", *dims))
    shown = ",\n         ".join(change_sql(name) for name in names)
    return (
        parts
        + periods_sql(comparisons)
        + side_sql("current", names, known, dims, day, where)
        + side_sql("prior", names, known, dims, day, where)
        + f"""
joined AS (
  SELECT {keys},
         {shown}
  FROM current_side c FULL OUTER JOIN prior_side p ON {same}
),
changes AS (
  SELECT q.current_period, q.prior_period, q.data_until, j.* FROM joined j JOIN periods q ON j.comparison = q.comparison
),
"""
    )


def compare_sql(parts, comparisons, names, known, dims, day, where="TRUE") -> str:
    return with_parts(
        compare_parts(parts, comparisons, names, known, dims, day, where), "SELECT * FROM changes"
    )


def contribution_sql(parts, comparisons, name, known, dims, day, where="TRUE") -> str:
    keys = ", ".join(dims)
    return with_parts(
        compare_parts(parts, comparisons, [name], known, dims, day, where),
        f"""SELECT h.comparison, h.current_period, h.prior_period, h.data_until, {keys}, {name}, {name}_prior, {name}_change,
       CAST(t.total_change AS BIGINT) AS total_change,
       round(CAST({name}_change AS DOUBLE) / nullif(CAST(t.total_change AS DOUBLE), 0), 6) AS share_of_change
FROM changes h
JOIN (SELECT comparison, sum({name}_change) AS total_change FROM changes GROUP BY comparison) t
  ON h.comparison = t.comparison""",
    )


SEGMENT = ["facility", "product"]
ORACLES: dict[str, str] = {}

ORACLES["account_gold"] = with_parts(SALES, "SELECT * EXCLUDE (discharge_department_id) FROM gold")
ORACLES["account_measures"] = with_parts(SALES, evaluate_sql(FINANCE_NAMES, FINANCE))
ORACLES["account_measures_by_segment"] = with_parts(
    SALES,
    evaluate_sql(
        FINANCE_NAMES,
        FINANCE,
        ["fiscal_year", *SEGMENT, "patient_type"],
        "discharge_date >= DATE '1996-10-01' AND financial_class_group <> '5-LOW'",
    ),
)
ORACLES["distinct_patients_by_segment"] = with_parts(
    SALES,
    evaluate_sql(["patients", "encounters"], FINANCE, ["facility", "service_line"], order="ORDER BY patients DESC, service_line"),
)
ORACLES["case_mix_by_status"] = with_parts(
    SALES,
    f"""SELECT patient_type, count(*) AS encounters, count(ms_drg_weight) AS encounters_with_weight,
       {FINANCE['case_mix_index']} AS case_mix_index
FROM accounts GROUP BY patient_type ORDER BY encounters DESC, patient_type""",
)
ORACLES["key_profile"] = """
SELECT 'accounts' AS source, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys FROM orders
UNION ALL SELECT 'departments', count(*), count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'service lines', count(*), count(DISTINCT n_nationkey) FROM nation
UNION ALL SELECT 'facilities', count(*), count(DISTINCT r_regionkey) FROM region
UNION ALL SELECT 'account lines', count(*), count(DISTINCT l_orderkey) FROM lineitem
"""
ORACLES["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
ORACLES["duplicate_probe"] = """
SELECT count(*) > 0 AS found FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
"""
ORACLES["orphans"] = "\nUNION ALL\n".join(
    f"SELECT '{left} without {right}' AS finding, {key} AS key, count(*) AS row_count\n"
    f"FROM {left} l WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE r.{other} = l.{key}) GROUP BY {key}"
    for left, key, right, other in (
        ("orders", "o_orderkey", "lineitem", "l_orderkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("documents", "doc_id", "labels", "doc_id"),
        ("labels", "doc_id", "documents", "doc_id"),
    )
)
ORACLES["gold_checks"] = with_parts(
    SALES,
    """SELECT 'account twice in gold' AS "check", (SELECT count(*) FROM (
         SELECT hospital_account_id FROM gold GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'account not in gold', (SELECT count(DISTINCT hospital_account_id) FROM accounts
  WHERE hospital_account_id NOT IN (SELECT hospital_account_id FROM gold))
UNION ALL SELECT 'gold without account', (SELECT count(DISTINCT hospital_account_id) FROM gold
  WHERE hospital_account_id NOT IN (SELECT hospital_account_id FROM accounts))
UNION ALL SELECT 'account without department', (SELECT count(DISTINCT o_orderkey) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'account without financials', (SELECT count(DISTINCT o_orderkey) FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""",
)
ORACLES["star_join"] = with_parts(
    SALES,
    """SELECT a.hospital_account_id, d.facility, e.first_shipped, e.quantity, f.estimated_net_revenue,
       d.department_id IS NOT NULL AS has_department, e.l_orderkey IS NOT NULL AS has_encounter,
       f.hospital_account_id IS NOT NULL AS has_financials
FROM accounts a
LEFT JOIN departments d ON a.discharge_department_id = d.department_id
LEFT JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_shipped,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
           FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey) e ON e.l_orderkey = a.hospital_account_id
LEFT JOIN financials f ON f.hospital_account_id = a.hospital_account_id""",
)


def grain_sql(parent: str, child: str, parent_key: str, child_key: str) -> str:
    return f"""SELECT
  (SELECT count(*) FROM {parent} p LEFT JOIN {child} c ON p.{parent_key} = c.{child_key}) AS rows_after_join,
  (SELECT count(DISTINCT {parent_key}) FROM {parent}) AS distinct_parents,
  (SELECT count(*) FROM (SELECT DISTINCT {parent_key} AS k FROM {parent}) p
     WHERE (SELECT count(*) FROM {child} c WHERE c.{child_key} = p.k) > 1) AS parents_with_many,
  (SELECT count(*) FROM (SELECT DISTINCT {parent_key} AS k FROM {parent}) p
     WHERE NOT EXISTS (SELECT 1 FROM {child} c WHERE c.{child_key} = p.k)) AS parents_without"""


ORACLES["join_grain"] = grain_sql("orders", "lineitem", "o_orderkey", "l_orderkey")
ORACLES["conversation_grain"] = with_parts(
    "openings AS (SELECT * FROM conversations WHERE turn = 0),",
    grain_sql("openings", "conversations", "conv_id", "conv_id"),
)


def reconcile_sql(source: str, label: str, column: str, frame: str) -> str:
    money = f"CAST(coalesce(sum({column}), 0) AS DECIMAL(38,2))"
    rows = "CAST(count(*) AS DECIMAL(38,2))"
    return "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source, '{total}' AS total, s.v AS source_value, g.v AS gold_value, "
        f"CAST(s.v - g.v AS DECIMAL(38,2)) AS difference "
        f"FROM (SELECT {what} AS v FROM {frame}) s, (SELECT {what} AS v FROM gold) g"
        for total, what in (("rows", rows), (label, money))
    )


ORACLES["reconcile_totals"] = with_parts(
    SALES,
    reconcile_sql("accounts", "charges", "total_charges", "accounts")
    + "\nUNION ALL\n"
    + reconcile_sql("financials", "revenue", "estimated_net_revenue", "financials"),
)
ORACLES["category_profile"] = """
SELECT o_orderpriority, count(*) AS orders,
       count(*) FILTER (WHERE o_totalprice >= 250000) AS large_orders,
       count(*) FILTER (WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL) AS with_price,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE)
             / nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0), 2) AS average_price
FROM orders GROUP BY o_orderpriority ORDER BY orders DESC, o_orderpriority
"""
ORACLES["manifest"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
)
ORACLES["date_extent"] = with_parts(SALES, "SELECT first_date, last_date, last_month FROM extent")
ORACLES["latest_complete_month"] = with_parts(
    SALES,
    "SELECT last_date, latest_complete_month, last_day(latest_complete_month) AS latest_complete_day FROM extent",
)
for key, name in (("mom_change", "mom"), ("yoy_change", "yoy"), ("mtd_matched_days", "mtd")):
    ORACLES[key] = compare_sql(SALES, [name], FINANCE_NAMES, FINANCE, SEGMENT, "discharge_date")
ORACLES["season_changes"] = compare_sql(
    SALES, ["season"], FINANCE_NAMES, FINANCE, ["facility", "service_line", "product"], "discharge_date"
)
ORACLES["season_matched"] = with_parts(
    SALES,
    """SELECT CAST(year(discharge_date) AS INTEGER) AS discharge_year,
       CAST(month(discharge_date) AS INTEGER) AS discharge_month, service_line, product, count(*) AS encounters
FROM accounts JOIN departments ON discharge_department_id = department_id
WHERE facility = 'ASIA' AND discharge_date >= DATE '1999-04-01' AND discharge_date < DATE '2000-09-01'
  AND month(discharge_date) BETWEEN 4 AND 8
GROUP BY ALL ORDER BY discharge_month, discharge_year, service_line, product""",
)
ORACLES["monthly_trend"] = with_parts(
    SALES,
    f"""SELECT discharge_month, {measured(FINANCE_NAMES, FINANCE)},
       (SELECT last_date FROM extent) AS data_until,
       last_day(discharge_month) > (SELECT last_date FROM extent) AS is_partial
FROM gold GROUP BY discharge_month""",
)
ORACLES["segment_contribution"] = contribution_sql(
    SALES, ["season"], "accounts", FINANCE, SEGMENT, "discharge_date", "patient_type = 'Inpatient'"
)
ORACLES["segment_financial_change"] = compare_sql(
    SALES,
    ["season"],
    ["accounts", "net_revenue", "revenue_after_direct"],
    FINANCE,
    SEGMENT,
    "discharge_date",
    "patient_type = 'Inpatient' AND facility = 'EUROPE'",
)


def expected_trend_sql(segment: str, year: int, frame: str) -> str:
    return f"""SELECT prior_year, current_year, prior_year > 0 AND current_year < prior_year AS fell
FROM (SELECT count(*) FILTER (WHERE year(discharge_date) = {year - 1}) AS prior_year,
             count(*) FILTER (WHERE year(discharge_date) = {year}) AS current_year
      FROM {frame}
      WHERE {segment} AND month(discharge_date) BETWEEN 4 AND 8)"""


ORACLES["expected_trend"] = with_parts(
    SALES,
    expected_trend_sql(
        "facility = 'AMERICA' AND product = 'BUILDING'",
        2000,
        "accounts JOIN departments ON discharge_department_id = department_id",
    ),
)
ORACLES["fiscal_periods"] = with_parts(
    SALES,
    f"""SELECT fiscal_year, fiscal_month, count(*) AS accounts, min(discharge_date) AS first_date,
       max(discharge_date) AS last_date
FROM (SELECT discharge_date, {fiscal('discharge_date')} FROM accounts)
GROUP BY fiscal_year, fiscal_month""",
)
ORACLES["headline"] = with_parts(
    SALES + periods_sql(["mom"]),
    f"""SELECT 'latest complete month' AS period, current_period AS dates, data_until,
       {measured(FINANCE_NAMES, FINANCE)}
FROM periods JOIN gold ON discharge_date BETWEEN cs AND ce GROUP BY current_period, data_until""",
)

# === Steps over given rows ===============================================================

ORACLES["returned_lines"] = """
SELECT l_returnflag, l_returnflag = 'R' AS returned, l_linestatus = 'O' AS open,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS returned_code, count(*) AS lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity
FROM lineitem GROUP BY ALL
"""
ORACLES["dates_as_text"] = """
SELECT strftime(l_shipdate, '%m/%Y') AS month_text, count(*) AS lines, count(*) AS same,
       CAST(min(l_shipdate) AS DATE) AS first_day
FROM lineitem GROUP BY 1
"""
ORACLES["account_age"] = with_parts(
    SALES,
    """SELECT CAST(date_sub('year', discharge_date, (SELECT last_date FROM extent)) AS INTEGER) AS years,
       count(*) AS accounts, max(discharge_date) AS youngest
FROM accounts GROUP BY 1""",
)
ORACLES["split_entities"] = with_parts(
    SALES,
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS entity, count(*) AS rows, count(DISTINCT {key}) AS distinct_keys, "
        f"CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM accounts"
        for name, key, amount in (
            ("accounts", "hospital_account_id", "total_charges"),
            ("patients", "patient_id", "total_charges"),
            ("encounters", "primary_encounter_id", "ms_drg_weight"),
        )
    ),
)
ORACLES["urgent_members"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient' ELSE 'Observation' END AS patient_type,
       o_orderpriority AS financial_class_group, count(*) AS accounts,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS charges
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
GROUP BY ALL
"""
ORACLES["keyed_sample"] = with_parts(
    SALES,
    """SELECT hospital_account_id, patient_id, discharge_date, patient_type, total_charges FROM accounts
WHERE CAST('0x' || substr(md5('42|sample|' || CAST(hospital_account_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000000
      < 100000""",
)
ORACLES["customer_months"] = """
WITH months AS (SELECT unnest([DATE '1999-01-01', DATE '1999-02-01', DATE '1999-03-01']) AS reporting_month),
counts AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL
)
SELECT c_mktsegment, reporting_month, count(*) AS customers, count(n) AS with_orders,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS orders
FROM customer CROSS JOIN months LEFT JOIN counts ON o_custkey = c_custkey AND month = reporting_month
GROUP BY c_mktsegment, reporting_month
"""
ORACLES["daily_spine"] = """
SELECT day, count(event_id) AS events, count(DISTINCT user_id) AS users
FROM (SELECT CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(40) t(i)) LEFT JOIN events ON CAST(ts AS DATE) = day
GROUP BY day
"""
ORACLES["inline_labels"] = """
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'looked' WHEN event_type = 'signup' THEN 'joined'
            WHEN event_type = 'purchase' THEN 'bought' END AS label,
       count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value
FROM events GROUP BY 1
"""

# === Text evidence: the rules are stated here again, on their own ==========================

ORACLES["keyword_candidates"] = """
SELECT d.doc_id, d.lang, d.source, b.quality, d.n_chars
FROM documents d JOIN labels b ON d.doc_id = b.doc_id
WHERE b.toxic = 0 AND regexp_matches(d.text, 'licen[sc]e|copyright|[Rr]eserved|@')
"""
GRANTS = """
clauses AS (
  SELECT doc_id, source, list_transform(regexp_split_to_array(text, '[.;!?\\n]+'), lambda c: trim(c, ' ')) AS c
  FROM documents
),
phrases AS (
  SELECT doc_id, source, list_filter(list_transform(range(1, len(c) + 1), lambda i:
    CASE WHEN regexp_matches(c[i], '([Ll]icensed|[Rr]eleased) under ') AND NOT contains(c[i], 'CC BY-NC')
              AND coalesce(c[i + 1], '') <> 'All rights reserved' THEN c[i] END), lambda p: p IS NOT NULL) AS p
  FROM clauses
),
"""
ORACLES["licence_grants"] = with_parts(
    GRANTS,
    "SELECT doc_id, source, CAST(unnest(range(len(p))) AS INTEGER) AS place, unnest(p) AS phrase FROM phrases",
)
ORACLES["licence_grants_by_source"] = with_parts(
    GRANTS,
    """SELECT source, TRUE AS note_intervention, count(*) AS evidence_notes,
       CAST(sum(len(p)) AS BIGINT) AS evidence_phrases, min(doc_id) AS evidence_note_id,
       arg_min(p[1], doc_id) AS evidence_phrase
FROM phrases WHERE len(p) > 0 GROUP BY source""",
)
ACTIVITY = """
ranked AS (
  SELECT *, CAST(date_trunc('week', ts) AS DATE) AS reporting_week,
         row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) AS back,
         row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS nth
  FROM events
),
encounters AS (
  SELECT user_id * 1000000 + date_diff('day', DATE '2024-01-01', reporting_week) // 7 AS encounter_id,
         user_id AS patient_id, CAST(max(ts) AS DATE) AS encounter_date, reporting_week,
         'hours ' || CAST(6 * (hour(max(ts)) // 6) AS VARCHAR) || '+' AS clinic,
         max(event_type) FILTER (WHERE nth = 1) AS coverage_type,
         max(CAST(json_extract_string(props, '$.k') AS INTEGER)) FILTER (WHERE back = 1) AS age_at_encounter,
         bool_or(event_type = 'error') AS has_copd, max(CAST(value AS DECIMAL(18,2))) > 100 AS has_diabetes,
         max(CASE event_type WHEN 'purchase' THEN 'current_user' WHEN 'click' THEN 'current_user'
                             WHEN 'view' THEN 'non_user' WHEN 'signup' THEN 'unknown' ELSE 'not_done' END)
           FILTER (WHERE back = 1) AS tobacco_screen_status,
         bool_or(event_type = 'purchase' AND CAST(value AS DECIMAL(18,2)) >= 60) AS structured_cessation_intervention
  FROM ranked GROUP BY user_id, reporting_week
),
assessments AS (
  SELECT c_custkey AS patient_id, c_acctbal < 0 AS transportation_barrier,
         c_mktsegment = 'HOUSEHOLD' AS housing_instability, c_nationkey < 5 AS food_insecurity
  FROM customer
),
notes AS (
  SELECT conv_id * 1000000 + turn AS note_id, conv_id AS patient_id, conv_id * 1000000 + turn % 5 AS encounter_id,
         role AS note_type, text AS note_text
  FROM conversations
),
clauses AS (
  SELECT *, list_transform(regexp_split_to_array(note_text, '[.;!?\\n]+'), lambda c: trim(c, ' ')) AS c FROM notes
),
labelled AS (
  SELECT * EXCLUDE (c), list_filter(list_transform(range(1, len(c) + 1), lambda i:
    CASE WHEN regexp_matches(c[i], '(^|\\P{L})(that|avec|nicht|por)(\\P{L}|$)')
              AND (regexp_matches(c[i], '(?i)(^|\\P{L})(the|la|der|el)(\\P{L}|$)')
                   OR (i > 1 AND regexp_matches(c[i - 1], '(?i)(^|\\P{L})(the|la|der|el)(\\P{L}|$)')
                       AND NOT regexp_matches(c[i], '(^|\\P{L})(from|pour|auf|con)(\\P{L}|$)')))
              AND NOT regexp_matches(c[i], '(^|\\P{L})(was|dans|zu|los)(\\P{L}|$)')
              AND NOT regexp_matches(coalesce(c[i + 1], ''), '^\\S+$') THEN c[i] END),
    lambda p: p IS NOT NULL) AS phrases
  FROM clauses
),
evidence AS (
  SELECT encounter_id, TRUE AS note_intervention, count(*) AS evidence_notes,
         CAST(sum(len(phrases)) AS BIGINT) AS evidence_phrases, min(note_id) AS evidence_note_id,
         arg_min(phrases[1], note_id) AS evidence_phrase
  FROM labelled WHERE len(phrases) > 0 GROUP BY encounter_id
),
joined_weeks AS (
  SELECT e.reporting_week, e.patient_id, e.encounter_id, e.clinic, e.coverage_type, e.age_at_encounter,
         e.has_copd, e.has_diabetes, s.transportation_barrier, s.housing_instability, s.food_insecurity,
         e.tobacco_screen_status, e.structured_cessation_intervention,
         coalesce(v.note_intervention, FALSE) AS note_intervention,
         coalesce(v.evidence_notes, 0) AS evidence_notes, coalesce(v.evidence_phrases, 0) AS evidence_phrases,
         v.evidence_note_id, v.evidence_phrase,
         e.structured_cessation_intervention OR coalesce(v.note_intervention, FALSE) AS has_intervention
  FROM encounters e
  LEFT JOIN evidence v ON e.encounter_id = v.encounter_id
  LEFT JOIN assessments s ON e.patient_id = s.patient_id
),
gold AS (
  SELECT *,
         CAST(age_at_encounter >= 12 AS INTEGER) AS screening_den,
         CAST(age_at_encounter >= 12 AND tobacco_screen_status IN ('current_user', 'non_user') AS INTEGER) AS screening_num,
         CAST(age_at_encounter >= 12 AND tobacco_screen_status = 'current_user' AS INTEGER) AS cessation_den,
         CAST(age_at_encounter >= 12 AND tobacco_screen_status = 'current_user' AND has_intervention AS INTEGER) AS cessation_num,
         CAST(age_at_encounter >= 12 AS INTEGER) AS combined_den,
         CAST(age_at_encounter >= 12 AND (tobacco_screen_status = 'non_user'
              OR tobacco_screen_status = 'current_user' AND has_intervention) AS INTEGER) AS combined_num,
         CAST(age_at_encounter >= 12 AND tobacco_screen_status = 'current_user' AND NOT has_intervention AS INTEGER) AS care_gap
  FROM joined_weeks
),
extent AS (
  SELECT max(encounter_date) AS last_date,
         CAST(date_trunc('week', max(encounter_date) + 1) AS DATE) - 7 AS week
  FROM encounters
),
"""
ORACLES["note_labels"] = with_parts(
    ACTIVITY,
    """SELECT note_id, encounter_id, note_type, CAST(len(phrases) AS INTEGER) AS n_phrases,
       CASE WHEN len(phrases) > 0 THEN 'provided' ELSE 'not_provided' END AS label FROM labelled""",
)
ORACLES["note_phrases"] = with_parts(
    ACTIVITY,
    """SELECT note_id, encounter_id, CAST(unnest(range(len(phrases))) AS INTEGER) AS place, unnest(phrases) AS phrase
FROM labelled""",
)
ORACLES["evidence_per_encounter"] = with_parts(ACTIVITY, "SELECT * FROM evidence")
ORACLES["note_gap_candidates"] = with_parts(
    ACTIVITY,
    """SELECT e.encounter_id, e.patient_id, e.reporting_week, n.note_id, n.note_text
FROM encounters e JOIN notes n ON e.encounter_id = n.encounter_id
WHERE age_at_encounter >= 12 AND tobacco_screen_status = 'current_user' AND NOT structured_cessation_intervention
  AND regexp_matches(note_text, '(^|\\P{L})(that|avec|nicht|por)(\\P{L}|$)')""",
)
ORACLES["representative_text"] = "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text"
ORACLES["contrast_sample"] = """
SELECT min(doc_id) AS doc_id, line, expected AS label, expected
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
JOIN (VALUES ('Licensed under the Apache License, Version 2.0.', 'provided'), ('Released under the MIT License.', 'provided'),
             ('Licensed under CC BY-NC 4.0.', 'not_provided'), ('All rights reserved.', 'not_provided')) known(line, expected)
  USING (line)
GROUP BY ALL
"""
KNOWN = """
known(line, expected, said) AS (
  VALUES ('Licensed under the Apache License, Version 2.0.', TRUE, TRUE), ('Released under the MIT License.', TRUE, TRUE),
         ('This work is licensed under the GNU General Public License, version 3.', TRUE, TRUE),
         ('Licensed under CC BY-NC 4.0.', FALSE, FALSE), ('All rights reserved.', FALSE, FALSE),
         ('Of.', FALSE, FALSE), ('The.', FALSE, FALSE), ('To whom it may concern: used by permission.', FALSE, FALSE)
),
lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
judged AS (
  SELECT k.line, k.expected, count(l.line) AS rows, CASE WHEN count(l.line) > 0 THEN k.said END AS provided
  FROM known k LEFT JOIN lines l ON k.line = l.line GROUP BY k.line, k.expected, k.said
),
"""
ORACLES["known_texts"] = with_parts(KNOWN, "SELECT *, provided = expected AS agrees FROM judged")
ORACLES["known_text_agreement"] = with_parts(
    KNOWN,
    """SELECT *, round(true_positive / CAST(nullif(true_positive + false_positive, 0) AS DOUBLE), 6) AS "precision",
       round(true_positive / CAST(nullif(true_positive + false_negative, 0) AS DOUBLE), 6) AS recall
FROM (SELECT CAST(coalesce(sum(rows) FILTER (WHERE expected AND provided), 0) AS BIGINT) AS true_positive,
             CAST(coalesce(sum(rows) FILTER (WHERE NOT expected AND provided), 0) AS BIGINT) AS false_positive,
             CAST(coalesce(sum(rows) FILTER (WHERE expected AND NOT provided), 0) AS BIGINT) AS false_negative,
             CAST(coalesce(sum(rows) FILTER (WHERE NOT expected AND NOT provided), 0) AS BIGINT) AS true_negative,
             CAST(coalesce(sum(rows) FILTER (WHERE provided IS NULL), 0) AS BIGINT) AS undecided
      FROM judged)""",
)
# Scopes by window functions over the words of a clause, where the library folds over them.
SCOPED = (
    ACTIVITY
    + """
scoped_clauses AS (
  SELECT note_id, unnest(range(len(c))) AS i, unnest(c) AS clause
  FROM (SELECT note_id, regexp_split_to_array(note_text, '[.;!?\\n]+') AS c FROM notes)
),
tokens AS (SELECT *, regexp_extract_all(lower(clause), '\\p{L}+|,') AS tk FROM scoped_clauses),
facts AS (
  SELECT note_id, i, list_has_any(tk, ['the', 'la', 'der', 'el']) AS topic,
         list_has_any(tk, ['from', 'pour', 'auf', 'con']) AS other_topic, list_has_any(tk, ['is', 'est', 'ist', 'es']) AS lifted,
         list_has_any(tk, ['that', 'avec', 'nicht', 'por']) AS has_care, regexp_matches(lower(clause), '^\\s*\\S+\\s*$') AS refusal
  FROM tokens
),
clause_facts AS (
  SELECT note_id, i, lifted, topic OR (coalesce(lag(topic) OVER n, FALSE) AND NOT other_topic) AS about,
         coalesce(lead(refusal AND NOT has_care AND NOT topic) OVER n, FALSE) AS taken
  FROM facts WINDOW n AS (PARTITION BY note_id ORDER BY i)
),
placed_words AS (SELECT note_id, i, unnest(range(1, len(tk) + 1)) AS p, unnest(tk) AS w FROM tokens),
opened AS (
  SELECT *, max(CASE WHEN w IN ('was', 'dans', 'zu', 'los') THEN p END) OVER b AS negation,
         max(CASE WHEN w IN ('of', 'de', 'von') THEN p END) OVER b AS plan, max(CASE WHEN w = ',' THEN p END) OVER b AS ended
  FROM placed_words
  WINDOW b AS (PARTITION BY note_id, i ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
held AS (
  SELECT *, coalesce(negation, 0) > coalesce(ended, 0) AS negated, coalesce(plan, 0) > coalesce(ended, 0) AS in_plan FROM opened
),
reached AS (
  SELECT *, max(CASE WHEN w IN ('and', 'et', 'und', 'y') THEN p END) OVER a AS past_cue,
         max(CASE WHEN w IN ('of', 'de', 'von') AND NOT in_plan THEN p END) OVER a AS plan_cue
  FROM held
  WINDOW a AS (PARTITION BY note_id, i ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
),
scoped AS (
  SELECT note_id, i, about, taken, negated, past_cue IS NOT NULL AS past,
         (in_plan OR plan_cue IS NOT NULL) AND NOT lifted AS planned
  FROM reached JOIN clause_facts USING (note_id, i) WHERE w IN ('that', 'avec', 'nicht', 'por')
),
"""
)
ORACLES["note_scopes"] = with_parts(
    SCOPED,
    """SELECT note_id, count(*) AS mentions, count(*) FILTER (WHERE about) AS about, count(*) FILTER (WHERE taken) AS taken,
       count(*) FILTER (WHERE negated) AS negated, count(*) FILTER (WHERE past) AS past,
       count(*) FILTER (WHERE planned) AS planned, count(*) FILTER (WHERE NOT (negated OR past OR planned)) AS affirmed,
       count(*) FILTER (WHERE NOT (negated OR past OR planned) AND about AND NOT taken) AS supporting
FROM scoped GROUP BY note_id""",
)
ORACLES["scoped_note_labels"] = with_parts(
    SCOPED,
    """SELECT CASE WHEN s.note_id IS NOT NULL THEN 'provided' ELSE 'not_provided' END AS by_scope,
       CASE WHEN len(l.phrases) > 0 THEN 'provided' ELSE 'not_provided' END AS by_clause, count(*) AS notes
FROM labelled l LEFT JOIN (SELECT DISTINCT note_id FROM scoped
     WHERE about AND NOT taken AND NOT (negated OR past OR planned)) s ON l.note_id = s.note_id
GROUP BY ALL""",
)
ORACLES["term_candidates"] = """
WITH item AS (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
term AS (
  SELECT DISTINCT array_to_string(w[i:i + 2], ' ') AS term FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM item)
),
worded AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
place AS (SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS term FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded))
SELECT doc_id, term, count(*) AS times FROM place JOIN term USING (term) GROUP BY ALL
"""

# === User-weeks and their measures ========================================================

ORACLES["patient_period_gold"] = with_parts(ACTIVITY, "SELECT * FROM gold")
ORACLES["activity_gold_checks"] = with_parts(
    ACTIVITY,
    """SELECT 'user-week twice in gold' AS "check", (SELECT count(*) FROM (
         SELECT 1 FROM gold GROUP BY patient_id, reporting_week HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'user-week not in gold', (SELECT count(*) FROM (
         SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) FROM events
         EXCEPT SELECT patient_id, reporting_week FROM gold))
UNION ALL SELECT 'gold without user-week', (SELECT count(*) FROM (
         SELECT patient_id, reporting_week FROM gold
         EXCEPT SELECT user_id, CAST(date_trunc('week', ts) AS DATE) FROM events))""",
)
ORACLES["quality_rates"] = with_parts(ACTIVITY, evaluate_sql(list(CLINICAL), CLINICAL))
ORACLES["quality_rates_by_cohort"] = with_parts(
    ACTIVITY, evaluate_sql(list(CLINICAL), CLINICAL, ["clinic", "has_copd", "has_diabetes", "transportation_barrier"])
)
ORACLES["quality_trend"] = with_parts(
    ACTIVITY,
    f"""SELECT reporting_week, clinic, {measured(list(CLINICAL), CLINICAL)},
       (SELECT last_date FROM extent) AS data_until,
       reporting_week + 6 > (SELECT last_date FROM extent) AS is_partial
FROM gold GROUP BY reporting_week, clinic""",
)
ORACLES["care_gaps"] = with_parts(
    ACTIVITY,
    evaluate_sql(
        ["care_gaps", "cessation_den"],
        CLINICAL,
        ["reporting_week", "clinic", "housing_instability", "food_insecurity"],
        "transportation_barrier",
    ),
)
ORACLES["num_le_den"] = with_parts(
    ACTIVITY,
    "\nUNION ALL\n".join(
        f"""SELECT clinic, '{name}' AS measure, CAST(sum({name}_num) AS BIGINT) AS numerator,
       CAST(sum({name}_den) AS BIGINT) AS denominator, count(*) FILTER (WHERE {name}_num > {name}_den) AS violating_rows,
       count(*) FILTER (WHERE {name}_num > {name}_den) = 0 AND sum({name}_num) <= sum({name}_den) AS holds
FROM gold GROUP BY clinic"""
        for name in ("screening", "cessation", "combined")
    ),
)
ORACLES["rate_point_change"] = compare_sql(ACTIVITY, ["latest_week"], list(CLINICAL), CLINICAL, [], "reporting_week")
ORACLES["two_week_compare"] = compare_sql(ACTIVITY, ["two_weeks"], list(CLINICAL), CLINICAL, ["clinic"], "reporting_week")
COHORT = ["clinic", "transportation_barrier"]
ORACLES["gap_contribution"] = contribution_sql(ACTIVITY, ["two_weeks"], "care_gaps", CLINICAL, COHORT, "reporting_week")
ORACLES["rate_contribution"] = with_parts(
    compare_parts(ACTIVITY, ["two_weeks"], ["cessation_num", "cessation_den"], CLINICAL, COHORT, "reporting_week")
    + """
whole AS (
  SELECT *, CAST(sum(cessation_num) OVER () AS DOUBLE) AS n1, CAST(sum(cessation_den) OVER () AS DOUBLE) AS d1,
         CAST(sum(cessation_num_prior) OVER () AS DOUBLE) AS n0, CAST(sum(cessation_den_prior) OVER () AS DOUBLE) AS d0
  FROM changes
),
shares AS (
  SELECT *, coalesce(cessation_den / nullif(d1, 0), 0) AS w1, coalesce(cessation_den_prior / nullif(d0, 0), 0) AS w0,
         CAST(cessation_num AS DOUBLE) / nullif(cessation_den, 0) AS own1,
         CAST(cessation_num_prior AS DOUBLE) / nullif(cessation_den_prior, 0) AS own0,
         n1 / nullif(d1, 0) AS all1, n0 / nullif(d0, 0) AS all0
  FROM whole
),
parts AS (
  SELECT *, (w1 + w0) / 2 * (coalesce(own1, own0, 0) - coalesce(own0, own1, 0)) AS by_rate,
         (w1 - w0) * ((coalesce(own1, own0, 0) + coalesce(own0, own1, 0)) / 2 - (all1 + all0) / 2) AS by_mix
  FROM shares
),
""",
    """SELECT comparison, current_period, prior_period, data_until, clinic, transportation_barrier,
       cessation_num, cessation_den, cessation_num_prior, cessation_den_prior,
       round(by_rate * 100, 4) AS rate_points, round(by_mix * 100, 4) AS mix_points,
       round((by_rate + by_mix) * 100, 4) AS points, round((all1 - all0) * 100, 4) AS total_points
FROM parts""",
)
ORACLES["attributes_left_join"] = """
SELECT d.lang, b.quality, b.toxic, count(*) AS documents, CAST(sum(d.n_chars) AS BIGINT) AS characters
FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id GROUP BY ALL
"""
ORACLES["encounter_preview"] = with_parts(
    ACTIVITY,
    """SELECT encounter_id, patient_id, reporting_week, clinic, age_at_encounter, tobacco_screen_status,
       structured_cessation_intervention, has_copd, has_diabetes FROM encounters ORDER BY encounter_id LIMIT 10""",
)
ORACLES["status_profile"] = with_parts(
    ACTIVITY,
    """SELECT tobacco_screen_status, count(*) AS encounters,
       count(*) FILTER (WHERE age_at_encounter >= 12) AS eligible FROM encounters GROUP BY 1""",
)
ORACLES["assessment_preview"] = with_parts(
    ACTIVITY, "SELECT * FROM assessments ORDER BY transportation_barrier DESC, patient_id LIMIT 10"
)
ORACLES["note_join_grain"] = with_parts(ACTIVITY, grain_sql("encounters", "notes", "encounter_id", "encounter_id"))
ORACLES["assessment_grain"] = """
SELECT count(*) AS assessment_rows, count(DISTINCT c_custkey) AS distinct_patients FROM customer
"""

# === Several levels, windows and slices at once ==============================================

ORACLES["account_levels"] = with_parts(
    SALES,
    f"""SELECT CASE WHEN GROUPING(facility) = 1 THEN 'overview' WHEN GROUPING(product) = 1 THEN 'facility' ELSE 'product' END AS level,
       facility, product, {measured(FINANCE_NAMES, FINANCE)}
FROM gold GROUP BY GROUPING SETS ((), (facility), (facility, product))""",
)
PATIENTS = "count(DISTINCT patient_id) AS patients, count(DISTINCT CASE WHEN surgical_case_flag THEN patient_id END) AS surgical_patients"
LOCATED = f"(SELECT *, {month('discharge_date')} AS discharge_month FROM accounts JOIN departments ON discharge_department_id = department_id)"
ORACLES["distinct_rollups"] = with_parts(
    SALES,
    f"""SELECT 'overall' AS level, CAST(NULL AS DATE) AS discharge_month, NULL AS facility, NULL AS product, {PATIENTS} FROM {LOCATED}
UNION ALL SELECT 'month', discharge_month, NULL, NULL, {PATIENTS} FROM {LOCATED} GROUP BY discharge_month
UNION ALL SELECT 'segment', NULL, facility, product, {PATIENTS} FROM {LOCATED} GROUP BY facility, product""",
)
ORACLES["rolling_windows"] = with_parts(
    SALES,
    """SELECT last_day, days, count(*) AS accounts, CAST(sum(total_charges) AS DECIMAL(38,2)) AS charges
FROM (SELECT CAST(DATE '1995-01-01' + 7 * CAST(i AS INTEGER) AS DATE) AS last_day, CAST(days AS INTEGER) AS days
      FROM range(345) w(i), (VALUES (7), (28), (91)) lengths(days))
JOIN accounts ON discharge_date > last_day - days AND discharge_date <= last_day
GROUP BY last_day, days""",
)
ORACLES["dense_trend"] = with_parts(
    SALES,
    f"""SELECT discharge_month, service_line, has_rows, accounts, accounts_before, accounts - accounts_before AS accounts_change,
       patients, patients_before, patients - patients_before AS patients_change, case_mix_index, case_mix_index_before,
       round(case_mix_index - case_mix_index_before, 6) AS case_mix_index_change
FROM (
  SELECT *, lag(accounts) OVER o AS accounts_before, lag(patients) OVER o AS patients_before,
         lag(case_mix_index) OVER o AS case_mix_index_before
  FROM (
    SELECT discharge_month, service_line, found IS NOT NULL AS has_rows, coalesce(accounts, 0) AS accounts,
           coalesce(patients, 0) AS patients, case_mix_index
    FROM (SELECT CAST(unnest(generate_series(min(discharge_month), max(discharge_month), INTERVAL 1 MONTH)) AS DATE) AS discharge_month
          FROM {LOCATED} WHERE facility = 'ASIA' AND surgical_case_flag)
    CROSS JOIN (SELECT DISTINCT service_line FROM {LOCATED} WHERE facility = 'ASIA' AND surgical_case_flag)
    LEFT JOIN (SELECT 1 AS found, discharge_month, service_line, {measured(["accounts", "patients", "case_mix_index"], FINANCE)}
               FROM {LOCATED} WHERE facility = 'ASIA' AND surgical_case_flag GROUP BY discharge_month, service_line)
      USING (discharge_month, service_line)
  ) WINDOW o AS (PARTITION BY service_line ORDER BY discharge_month)
)""",
)
SLICED = ["clinic", "transportation_barrier", "has_copd", "has_diabetes"]
ORACLES["rate_slices"] = with_parts(
    compare_parts(ACTIVITY, ["two_weeks"], ["cessation_num", "cessation_den"], CLINICAL, SLICED, "reporting_week")
    + f"""
cubed AS (
  SELECT {", ".join(SLICED)}, concat_ws(',', {", ".join(f"CASE WHEN GROUPING({d}) = 0 THEN '{d}' END" for d in SLICED)}) AS fixed,
         {" + ".join(f"(1 - GROUPING({d}))" for d in SLICED)} AS n_dims,
         {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("cessation_num", "cessation_den", "cessation_num_prior", "cessation_den_prior"))}
  FROM changes GROUP BY CUBE ({", ".join(SLICED)})
),
overall AS (
  SELECT CAST(cessation_num AS DOUBLE) AS n1, CAST(cessation_den AS DOUBLE) AS d1, CAST(cessation_num_prior AS DOUBLE) AS n0,
         CAST(cessation_den_prior AS DOUBLE) AS d0 FROM cubed WHERE n_dims = 0
),
weighed AS (
  SELECT cubed.*, coalesce(cessation_den / nullif(d1, 0), 0) AS w1, coalesce(cessation_den_prior / nullif(d0, 0), 0) AS w0,
         CAST(cessation_num AS DOUBLE) / nullif(cessation_den, 0) AS own1,
         CAST(cessation_num_prior AS DOUBLE) / nullif(cessation_den_prior, 0) AS own0,
         n1 / nullif(d1, 0) AS all1, n0 / nullif(d0, 0) AS all0
  FROM cubed, overall WHERE n_dims > 0
),
slice_parts AS (
  SELECT *, (w1 + w0) / 2 * (coalesce(own1, own0, 0) - coalesce(own0, own1, 0)) * 100 AS by_rate,
         (w1 - w0) * ((coalesce(own1, own0, 0) + coalesce(own0, own1, 0)) / 2 - (all1 + all0) / 2) * 100 AS by_mix
  FROM weighed WHERE greatest(w1, w0) >= 0.02
),
""",
    f"""SELECT fixed, CAST(n_dims AS INTEGER) AS n_dims, {", ".join(SLICED)}, cessation_num, cessation_den, cessation_num_prior, cessation_den_prior,
       round(greatest(w1, w0), 6) AS share, round(by_rate, 4) AS rate_points, round(by_mix, 4) AS mix_points,
       round(by_rate + by_mix, 4) AS points FROM slice_parts""",
)
ORACLES["row_reconciliation"] = with_parts(
    SALES,
    """SELECT hospital_account_id, CAST(1 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS gold_rows, 'estimated_net_revenue' AS differs
FROM gold JOIN (
  SELECT l_orderkey, round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(10,6)))), 2) AS once
  FROM lineitem GROUP BY l_orderkey) ON hospital_account_id = l_orderkey
WHERE CAST(once AS DECIMAL(18,2)) <> estimated_net_revenue""",
)
ORACLES["refreshed_accounts"] = with_parts(
    SALES,
    "SELECT patient_type, count(*) AS accounts, CAST(sum(total_charges) AS DECIMAL(38,2)) AS charges FROM accounts GROUP BY patient_type",
)

# === Scan and sort forms ==================================================================

ORACLES["preview_ordered"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10
"""
ORACLES["mixed_order_topk"] = """
SELECT c_custkey, c_mktsegment, c_acctbal > 0 AS in_credit FROM customer ORDER BY in_credit DESC, c_custkey LIMIT 10
"""
ORACLES["param_scan"] = """
SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY ALL ORDER BY orders DESC, o_orderpriority
"""
