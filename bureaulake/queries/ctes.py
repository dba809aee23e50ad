"""Shared CTEs of the oracle SQL: the bureau views, facts, features and scores restated for DuckDB.

``sql(select)`` prefixes a SELECT with exactly the CTEs it names, in dependency order.
"""

from __future__ import annotations

import re


def ladder(expr: str, op: str, pairs: str, otherwise: str) -> str:
    """``CASE`` over hand-written ``cut:weight`` pairs."""
    whens = " ".join(
        f"WHEN {expr} {op} {cut} THEN {w}e0" for cut, w in (p.split(":") for p in pairs.split()))
    return f"(CASE {whens} ELSE {otherwise}e0 END)"


CTES: dict[str, str] = {}

CTES["applicant"] = """
SELECT c_custkey AS applicant_id, 'REQ-' || c_custkey AS request_id,
  CASE WHEN c_custkey % 10 <= 6 THEN 'HIT' WHEN c_custkey % 10 IN (7, 8) THEN 'THIN_FILE' ELSE 'NO_RECORD' END AS hit_status,
  c_custkey % 10 <= 6 AS has_45, (c_custkey % 10 < 3 OR c_custkey % 10 IN (7, 8)) AS has_49,
  CASE WHEN c_custkey % 17 <> 0 THEN DATE '1930-01-01' + CAST((c_custkey * 7919) % 27000 AS INTEGER) END AS birth_day,
  c_custkey % 7 AS dependants, c_mktsegment <> 'HOUSEHOLD' AS has_employer,
  CASE WHEN c_custkey % 11 <> 0 THEN 'GHA-' || c_custkey END AS national_id,
  c_custkey % 5 AS delinquency, c_custkey % 23 = 0 AS judgement_found, c_custkey % 29 = 0 AS has_adverse,
  least(c_custkey % 13, 3) AS bounced_cheques, (c_custkey % 4) * 150e0 AS instalment_49
FROM customer"""

CTES["line_sum"] = """
SELECT l_orderkey, sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) / 2 AS half_open,
  max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1"""

CTES["account"] = """
SELECT o_custkey AS applicant_id, o_orderkey AS account_id, o_custkey % 10 <= 6 AS in_45,
  (o_custkey % 10 < 3 OR o_custkey % 10 IN (7, 8)) AND o_orderpriority = '1-URGENT' AS in_49,
  CASE WHEN o_orderkey % 12 < 8 OR o_orderkey % 53 IN (8, 21)
    THEN (['A','A','A','A','C','C','P','T','W','G','L','D'])[o_orderkey % 12 + 1] ELSE 'A' END AS status_code,
  CASE WHEN o_orderkey % 29 < 3 THEN o_orderkey % 5 ELSE 0 END AS months_in_arrears,
  o_totalprice AS opening_balance, coalesce(half_open, 0e0) AS current_balance,
  CAST(o_orderdate AS DATE) AS opened, o_orderkey % 3 AS layout,
  CASE WHEN o_orderstatus = 'F' THEN CAST(last_ship AS DATE) END AS closed, o_orderpriority AS account_type,
  ' Plot ' || (o_orderkey % (o_custkey % 3 + 1)) AS address
FROM orders LEFT JOIN line_sum ON o_orderkey = l_orderkey
WHERE o_custkey % 10 <= 6 OR o_custkey % 10 IN (7, 8)"""

CTES["report_account"] = """
SELECT *, account_id + CASE WHEN in_45 THEN 0 ELSE 1152921504606846976 END AS pos FROM account WHERE in_45 OR in_49"""

CTES["month_code"] = """
SELECT applicant_id, k, CASE WHEN k > 24 - (applicant_id % 4) * 6 THEN ''
  WHEN (o * 31 + k * 17) % 13 < 13 - applicant_id % 10 THEN '0'
  WHEN (o * 31 + k * 17) % 13 = 12 AND applicant_id % 3 = 0 THEN CAST(o % 6 + 1 AS VARCHAR) ELSE '#' END AS code
FROM (SELECT o_custkey AS applicant_id, min(o_orderkey) AS o FROM orders WHERE o_custkey % 10 <= 6 GROUP BY 1),
  range(1, 25) AS r(k)"""

CTES["payment"] = """
SELECT applicant_id, count(*) FILTER (code = '0') AS months_on_time,
  coalesce(min(k) FILTER (code <> '0') - 1, 24) AS current_streak,
  coalesce(max(TRY_CAST(code AS INTEGER)), 0) AS worst_month
FROM month_code GROUP BY 1"""

CTES["enquiry"] = """
SELECT applicant_id, event_id AS position, source,
  CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS VARCHAR) END AS enquiry_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_requested, CAST(ts AS DATE) AS asked, 'Lender ' || upper(event_type) AS subscriber
FROM (SELECT *, user_id * 10 + event_id % 10 AS applicant_id FROM events) e, (VALUES (45), (49)) s(source)
WHERE (source = 45 AND event_type IN ('view', 'click', 'signup') AND applicant_id % 10 <= 6)
   OR (source = 49 AND event_type IN ('click', 'purchase', 'error') AND (applicant_id % 10 < 3 OR applicant_id % 10 IN (7, 8)))"""

CTES["merged"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY applicant_id, enquiry_key ORDER BY source, position) AS rn FROM (
    SELECT *, CASE WHEN enquiry_id IS NOT NULL THEN 'id|' || enquiry_id
      ELSE 'fb|' || CAST(asked AS VARCHAR) || '|' || lower(subscriber) END AS enquiry_key FROM enquiry)) WHERE rn = 1"""

CTES["asked"] = """
SELECT applicant_id, count(*) AS enquiries_total, count(*) FILTER (DATE '2024-04-20' - asked <= 90) AS enquiries_3m,
  count(*) FILTER (DATE '2024-04-20' - asked <= 365) AS enquiries_12m
FROM merged GROUP BY 1"""

CTES["account_fact"] = """
SELECT applicant_id,
  least(greatest(coalesce(avg(current_balance / opening_balance) FILTER (in_45 AND opening_balance > 0), 0e0), 0e0), 1.2e0) AS utilisation,
  greatest(0, (2001 - year(min(opened) FILTER (in_45))) * 12 + 12 - month(min(opened) FILTER (in_45))) AS credit_age,
  count(*) FILTER (in_45 AND closed IS NOT NULL AND status_code NOT IN ('W','G','L','X','D')) AS closed_good,
  count(*) FILTER (in_45) AS total_accounts, count(*) FILTER (in_45 AND status_code = 'A') AS active_accounts,
  count(*) FILTER (in_45 AND months_in_arrears > 0) AS accounts_in_arrear,
  max(months_in_arrears) FILTER (in_45) AS arrears_max,
  CAST(sum(months_in_arrears) FILTER (in_45) AS DOUBLE) * 50 AS arrear_amount,
  sum(opening_balance * (applicant_id % 8) / 200) FILTER (in_45) AS debt,
  count(*) FILTER (in_49) AS mobile_count,
  max(opening_balance * ((applicant_id // 10) % 9) / 600) FILTER (in_49) AS mobile_max,
  count(DISTINCT account_type) FILTER (in_45) AS product_diversity,
  count(DISTINCT trim(address)) FILTER (in_45) AS distinct_addresses,
  bool_or(status_code = 'W') AS written_off, bool_or(status_code = 'G') AS charged_off, bool_or(status_code = 'L') AS legal_handover,
  count(*) AS n_accounts,
  arg_min(status_code, pos) FILTER (status_code IN ('D','E','RV')) AS first_excluded,
  bool_or(status_code IN ('W','G','L','X') OR (status_code = 'A' AND months_in_arrears >= 3)) AS saw_default,
  bool_or(NOT (status_code = 'A' AND months_in_arrears IN (1, 2))) AS saw_decided,
  max(opening_balance) FILTER (status_code IN ('C', 'P') AND opening_balance > 0) AS max_repaid
FROM report_account GROUP BY 1"""

CTES["fact"] = """
SELECT a.*, coalesce(utilisation, 0e0) AS utilisation, coalesce(credit_age, 0) AS credit_age, coalesce(closed_good, 0) AS closed_good,
  coalesce(total_accounts, 0) AS total_accounts, coalesce(active_accounts, 0) AS active_accounts,
  coalesce(accounts_in_arrear, 0) AS accounts_in_arrear, coalesce(arrear_amount, 0e0) AS arrear_amount,
  coalesce(debt, 0e0) AS outstanding_debt, coalesce(debt, 0e0) / 24 AS instalment_45,
  coalesce(mobile_count, 0) AS mobile_count, coalesce(mobile_max, 0e0) AS mobile_max,
  coalesce(product_diversity, 0) AS product_diversity, coalesce(distinct_addresses, 0) AS distinct_addresses,
  coalesce(written_off, false) AS written_off, coalesce(charged_off, false) AS charged_off,
  coalesce(legal_handover, false) AS legal_handover, coalesce(n_accounts, 0) AS n_accounts, first_excluded,
  coalesce(saw_default, false) AS saw_default, coalesce(saw_decided, false) AS saw_decided, max_repaid,
  coalesce(months_on_time, 0) AS months_on_time, coalesce(current_streak, 0) AS current_streak,
  coalesce(greatest(worst_month, arrears_max), 0) AS worst_arrears,
  coalesce(enquiries_3m, 0) AS enquiries_3m, coalesce(enquiries_12m, 0) AS enquiries_12m,
  coalesce(enquiries_total, 0) AS enquiries_total,
  CASE WHEN has_45 AND birth_day IS NOT NULL AND date_sub('year', birth_day, DATE '2012-06-30') > 0
    THEN date_sub('year', birth_day, DATE '2012-06-30') END AS applicant_age_years
FROM applicant a LEFT JOIN account_fact USING (applicant_id) LEFT JOIN payment USING (applicant_id)
  LEFT JOIN asked USING (applicant_id)"""


def hit(expr: str, no_record: str, thin: str = "NULL") -> str:
    return (f"CASE hit_status WHEN 'HIT' THEN {expr} WHEN 'THIN_FILE' THEN {thin} "
            f"ELSE {no_record} END")


_AGE = ladder("applicant_age_years", "<=", "25:0.7 40:1.0 60:0.9", "0.65")
_DEPENDANTS = ladder("dependants", "<=", "0:1.0 2:0.85 4:0.65", "0.4")
_ENQ3 = ladder("enquiries_3m", "<=", "1:1.0 3:0.75 5:0.35", "0.05")
_ENQ12 = ladder("enquiries_12m", "<=", "2:1.0 5:0.8 10:0.4", "0.1")
_MOBILE_N = ladder("mobile_count", ">=", "20:1.0 10:0.95 5:0.85 1:0.6", "0.2")
_MOBILE_MAX = ladder("mobile_max", "<=", "0:0.2 500:0.4 2000:0.6 5000:0.8", "1.0")
_INSTALMENT = ladder(
    "((CASE WHEN has_45 THEN instalment_45 ELSE 0e0 END) + (CASE WHEN has_49 THEN instalment_49 ELSE 0e0 END))",
    "<=", "500:1.0 2000:0.85 5000:0.6 15000:0.3", "0.05")
_RATING = "(CASE delinquency WHEN 0 THEN 1e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.7e0 WHEN 3 THEN 0.85e0 ELSE 0e0 END)"


def _flag(expr: str) -> str:
    return f"(CASE WHEN {expr} THEN 1e0 ELSE 0e0 END)"


# expression before imputation, imputed value for thin files, imputed value for hits without mobile report
FEATURE_SQL = {
    "highest_delinquency_rating": (hit(_RATING, "0e0", _RATING), None, None),
    "months_on_time_24m": (hit(ladder("months_on_time", ">=", "20:1.0 15:0.8 10:0.55 5:0.25", "0.0"), "0e0"), "0.55", None),
    "worst_arrears_24m": (hit(ladder("worst_arrears", "<=", "0:1.0 1:0.7 2:0.4 5:0.15", "0.0"), "0e0"), "0.0", None),
    "current_streak_on_time": (hit(ladder("current_streak", ">=", "12:1.0 6:0.75 3:0.45", "0.2"), "0.2e0"), "0.45", None),
    "has_active_arrears": (hit("(CASE WHEN accounts_in_arrear > 0 THEN 0e0 ELSE 1e0 END)", "0e0"), None, None),
    "total_arrear_amount_ghs": (hit(ladder("arrear_amount", "<=", "0:1.0 500:0.7 2000:0.35 10000:0.1", "0.0"), "1e0"), None, None),
    "total_outstanding_debt_ghs": (hit(ladder("outstanding_debt", "<=", "0:1.0 10000:0.8 50000:0.6 150000:0.3", "0.05"), "1e0"), None, None),
    "utilisation_ratio": (hit(ladder("utilisation", "<=", "0.25:1.0 0.5:0.8 0.75:0.5 0.9:0.2", "0.05"), "1e0"), None, None),
    "num_active_accounts": (hit(ladder("active_accounts", "<=", "1:0.85 3:1.0 5:0.55", "0.15"), "0.15e0"), None, None),
    "total_monthly_instalment_ghs": (hit(_INSTALMENT, "1e0", _INSTALMENT), None, None),
    "credit_age_months": (hit("(CASE WHEN credit_age > 84 THEN 1e0 WHEN credit_age >= 48 THEN 0.85e0 WHEN credit_age >= 24 "
                              "THEN 0.65e0 WHEN credit_age >= 12 THEN 0.4e0 ELSE 0.15e0 END)", "0.15e0"), None, None),
    "num_accounts_total": (hit(ladder("total_accounts", ">=", "10:1.0 5:0.8 3:0.55 1:0.3", "0.0"), "0e0"), None, None),
    "num_closed_accounts_good": (hit(ladder("closed_good", ">=", "5:1.0 3:0.75 1:0.45", "0.1"), "0.1e0"), None, None),
    "product_diversity_score": (hit(ladder("product_diversity", ">=", "4:1.0 3:0.8 2:0.55 1:0.3", "0.0"), "0.3e0"), "0.0", None),
    "mobile_loan_history_count": (f"CASE WHEN has_49 THEN {_MOBILE_N} WHEN hit_status = 'NO_RECORD' THEN 0.2e0 END", None, "0.0"),
    "mobile_max_loan_ghs": (f"CASE WHEN has_49 THEN {_MOBILE_MAX} WHEN hit_status = 'NO_RECORD' THEN 0e0 END", None, "0.0"),
    "has_judgement": (hit(_flag("judgement_found"), "0e0"), "0.0", None),
    "has_written_off": (hit(_flag("written_off"), "0e0", _flag("written_off")), None, None),
    "has_charged_off": (hit(_flag("charged_off"), "0e0", _flag("charged_off")), None, None),
    "has_legal_handover": (hit(_flag("legal_handover"), "0e0", _flag("legal_handover")), None, None),
    "num_bounced_cheques": (hit(ladder("bounced_cheques", "<=", "0:1.0 1:0.7 2:0.35", "0.05"), "0e0"), "0.0", None),
    "has_adverse_default": (hit(_flag("has_adverse"), "0e0"), "0.0", None),
    "num_enquiries_3m": (hit(_ENQ3, "1e0", _ENQ3), None, None),
    "num_enquiries_12m": (hit(_ENQ12, "1e0", _ENQ12), None, None),
    "enquiry_reason_flags": (hit(_flag("enquiries_total > 0"), "0e0", _flag("enquiries_total > 0")), None, None),
    "applicant_age": (f"CASE WHEN applicant_age_years < 18 OR applicant_age_years > 75 THEN 0e0 "
                      f"WHEN applicant_age_years IS NOT NULL THEN {_AGE} END", None, None),
    "identity_verified": ("CASE WHEN has_45 AND national_id IS NOT NULL THEN 1e0 END", None, None),
    "num_dependants": (hit(_DEPENDANTS, "NULL", _DEPENDANTS), None, None),
    "has_employer_detail": (hit("(CASE WHEN has_employer THEN 1e0 ELSE 0.6e0 END)", "NULL",
                                "(CASE WHEN has_employer THEN 1e0 ELSE 0.6e0 END)"), None, None),
    "address_stability": (hit(ladder("distinct_addresses", "<=", "1:1.0 2:0.75", "0.4"), "NULL"), "0.75", None),
}
FEATURE_NAMES = list(FEATURE_SQL)


def _imputed(name: str) -> str:
    expr, thin, no_mobile = FEATURE_SQL[name]
    if thin is not None:
        return f"CASE WHEN hit_status = 'THIN_FILE' THEN {thin}e0 ELSE {expr} END"
    if no_mobile is not None:
        return f"CASE WHEN hit_status = 'HIT' AND NOT has_49 THEN {no_mobile}e0 ELSE {expr} END"
    return expr


CTES["feature"] = "SELECT *, " + ",\n  ".join(f"{_imputed(n)} AS {n}" for n in FEATURE_NAMES) + "\nFROM fact"
CTES["raw_feature"] = "SELECT *, " + ",\n  ".join(f"{FEATURE_SQL[n][0]} AS {n}" for n in FEATURE_NAMES) + "\nFROM fact"


def _mean(*names: str) -> str:
    total = " + ".join(f"coalesce({n}, 0e0)" for n in names)
    return f"least(greatest(({total}) / {len(names)}, 0e0), 1e0)"


_AGE_IN_SCORE = (f"(CASE WHEN coalesce(applicant_age_years, 0) < 18 OR applicant_age_years > 75 THEN 0e0 ELSE {_AGE} END)")

CTES["grouped"] = f"""
SELECT *, {_mean(*FEATURE_NAMES[0:6])} AS group_a, {_mean(*FEATURE_NAMES[6:10])} AS group_b,
  {_mean(*FEATURE_NAMES[10:15])} AS group_c,
  least(greatest(1e0 - (CASE WHEN has_charged_off = 1 THEN 120e0/550 ELSE 0e0 END)
    - (CASE WHEN has_legal_handover = 1 THEN 80e0/550 ELSE 0e0 END)
    - (CASE WHEN has_adverse_default = 1 THEN 100e0/550 ELSE 0e0 END)
    - (CASE WHEN num_bounced_cheques = 1 THEN 20e0/550 ELSE 0e0 END), 0e0), 1e0) AS group_d,
  {_mean("num_enquiries_3m", "num_enquiries_12m")} AS group_e,
  {_mean(_AGE_IN_SCORE, "identity_verified", "num_dependants", "has_employer_detail", "address_stability")} AS group_f
FROM feature"""

CTES["raw_scored"] = """
SELECT *, CAST(round_even(300e0 + 550e0 * least(greatest(
    0.35e0 * group_a + 0.25e0 * group_b + 0.15e0 * group_c + 0.15e0 * group_d + 0.05e0 * group_e + 0.05e0 * group_f, 0e0), 1e0), 0) AS INTEGER) AS raw_score,
  CASE WHEN applicant_age_years < 18 OR applicant_age_years > 75 THEN 'AGE_INELIGIBLE'
    WHEN identity_verified = 0 THEN 'KYC_FAIL' WHEN has_judgement = 1 THEN 'LEGAL_HOLD'
    WHEN has_written_off = 1 THEN 'WRITE_OFF_HISTORY' END AS stop_code
FROM grouped"""

GRADE = ("(CASE WHEN {s} >= 750 THEN 'A' WHEN {s} >= 700 THEN 'B' WHEN {s} >= 650 THEN 'C' WHEN {s} >= 600 THEN 'D' "
         "WHEN {s} >= 520 THEN 'E' ELSE 'F' END)")
TIER = ("(CASE WHEN {s} >= 750 THEN 'VERY_LOW' WHEN {s} >= 700 THEN 'LOW' WHEN {s} >= 600 THEN 'MEDIUM' "
        "WHEN {s} >= 520 THEN 'HIGH' ELSE 'VERY_HIGH' END)")

CTES["matrix"] = f"""
SELECT *, CASE WHEN hit_status = 'NO_RECORD' THEN 'REFER'
  WHEN hit_status = 'THIN_FILE' THEN CASE WHEN grade IN ('A','B','C','D') THEN 'CONDITIONAL_APPROVE' WHEN grade = 'E' THEN 'REFER' ELSE 'DECLINE' END
  WHEN grade IN ('A','B','C') THEN 'APPROVE' WHEN grade = 'D' THEN 'CONDITIONAL_APPROVE' WHEN grade = 'E' THEN 'REFER'
  ELSE 'DECLINE' END AS matrix_decision
FROM (SELECT *, {GRADE.format(s='raw_score')} AS grade FROM raw_scored)"""

CTES["scored"] = f"""
SELECT *, {GRADE.format(s='credit_score')} AS score_grade, {TIER.format(s='credit_score')} AS risk_tier,
  CASE WHEN stop_code IS NOT NULL THEN 'DECLINE' ELSE matrix_decision END AS decision,
  CASE WHEN stop_code IS NOT NULL THEN stop_code
    WHEN reasons = '' THEN CASE WHEN matrix_decision = 'APPROVE' THEN 'R09' ELSE '' END ELSE reasons END AS decision_reason_codes,
  CASE WHEN stop_code IS NULL AND matrix_decision = 'CONDITIONAL_APPROVE'
    THEN CASE WHEN coalesce(applicant_age_years, 0) > 65 THEN 'CA-02' ELSE 'CA-05' END END AS condition_applied
FROM (SELECT *, CASE WHEN stop_code IS NOT NULL THEN 300 ELSE raw_score END AS credit_score,
  concat_ws(',', CASE WHEN highest_delinquency_rating < 0.5 THEN 'R01' END, CASE WHEN utilisation_ratio < 0.5 THEN 'R02' END,
    CASE WHEN total_outstanding_debt_ghs < 0.35 THEN 'R04' END, CASE WHEN num_enquiries_3m <= 0.35e0 THEN 'R05' END,
    CASE WHEN has_active_arrears < 1 THEN 'R06' END) AS reasons FROM matrix)"""

CTES["prediction"] = """
SELECT c_custkey AS applicant_id, 'REQ-' || c_custkey AS request_id, (c_custkey * 37) % 1000 / 1000e0 AS probability_of_default,
  -0.3e0 - (c_custkey * 53) % 400 / 1000e0 AS anomaly_raw, 500e0 + (c_custkey * 97) % 12000 AS recommended_loan_amount,
  CAST(c_custkey % 4 AS INTEGER) AS income_tier, (c_custkey * 13) % 100 / 100e0 AS income_confidence
FROM customer"""


def sql(select: str, **extra: str) -> str:
    """SELECT with the CTEs it needs; ``extra`` adds CTEs of its own (later ones may use earlier ones)."""
    pool = {**CTES, **extra}
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", text):
            if word in pool and word not in order:
                visit(pool[word])
                order.append(word)

    visit(select)
    if not order:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS ({pool[n].strip()})" for n in order) + "\n" + select.strip()
