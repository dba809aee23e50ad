"""Queries: account measures, features, scores and decisions (one row per applicant)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.catalog import AsOf
from bureaulake.functions import accounts as acc
from bureaulake.functions import parse, scoring
from bureaulake.operators import features
from bureaulake.plans import facts
from bureaulake.queries.ctes import FEATURE_NAMES, GRADE, TIER, sql
from bureaulake.sources import views

QUERIES, ORACLE = {}, {}
AS_OF = AsOf()


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def _report_accounts(spark, d):
    return views.accounts(spark, d).filter("in_45")


@query("payment_metrics", sql("SELECT applicant_id, months_on_time, current_streak, worst_month FROM payment"))
def payment_metrics(spark, d):
    return facts.payment_facts(views.payment_histories(spark, d)).select(
        "applicant_id", "months_on_time", "current_streak", "worst_month")


@query("streaks", sql("""SELECT applicant_id, coalesce(min(k) FILTER (code <> '0') - 1, 24) AS lead_months,
  count(*) FILTER (code = '0') AS on_time FROM month_code GROUP BY 1"""))
def streaks(spark, d):
    codes = F.col("codes")
    return views.payment_histories(spark, d).select(
        "applicant_id", acc.leading_on_time(codes).cast("long").alias("lead_months"),
        acc.months_on_time(codes).cast("long").alias("on_time"))


@query("credit_age", sql("SELECT applicant_id, credit_age FROM account_fact WHERE total_accounts > 0"))
def credit_age(spark, d):
    opened = parse.parse_date(F.col("date_opened"))
    return _report_accounts(spark, d).groupBy("applicant_id").agg(
        acc.credit_age(acc.oldest(opened), AS_OF.accounts).alias("credit_age"))


@query("closed_good", sql("SELECT applicant_id, closed_good FROM account_fact WHERE total_accounts > 0"))
def closed_good(spark, d):
    return _report_accounts(spark, d).groupBy("applicant_id").agg(
        acc.closed_good(F.col("status_code"), F.col("closed_date")).alias("closed_good"))


@query("diversity_counts", sql(
    "SELECT applicant_id, product_diversity, distinct_addresses FROM account_fact WHERE total_accounts > 0"))
def diversity_counts(spark, d):
    # Distinct pairs first, so both set sizes come from a handful of rows per applicant.
    pairs = _report_accounts(spark, d).select(
        "applicant_id", acc.normal_text(F.col("account_type")).alias("t"), acc.normal_text(F.col("address")).alias("a")).distinct()
    return pairs.groupBy("applicant_id").agg(
        F.count_distinct("t").alias("product_diversity"), F.count_distinct("a").alias("distinct_addresses"))


@query("status_flags", sql("SELECT applicant_id, written_off, charged_off, legal_handover FROM account_fact"))
def status_flags(spark, d):
    return views.accounts(spark, d).filter("in_45 or in_49").groupBy("applicant_id").agg(
        *[acc.has_status(F.col("status_code"), s).alias(n)
          for s, n in (("W", "written_off"), ("G", "charged_off"), ("L", "legal_handover"))])


@query("utilisation", sql(
    "SELECT applicant_id, round(utilisation, 6) AS utilisation FROM account_fact WHERE total_accounts > 0"))
def utilisation(spark, d):
    ratio = acc.utilisation(F.col("current_balance"), F.col("opening_balance"))
    return _report_accounts(spark, d).groupBy("applicant_id").agg(F.round(ratio, 6).alias("utilisation"))


@query("enquiry_merge", sql("SELECT applicant_id, enquiry_key, source, position, subscriber FROM merged"))
def enquiry_merge(spark, d):
    return facts.merged_enquiries(views.enquiries(spark, d)).select(
        "applicant_id", "enquiry_key", "source", "position", "subscriber")


@query("enquiry_counts", sql("SELECT applicant_id, enquiries_3m, enquiries_12m, enquiries_total FROM asked"))
def enquiry_counts(spark, d):
    return facts.enquiry_facts(facts.merged_enquiries(views.enquiries(spark, d)))


@query("default_flag", sql("""SELECT applicant_id, CASE WHEN first_excluded IS NOT NULL THEN NULL WHEN saw_default THEN 1
    WHEN saw_decided THEN 0 END AS default_flag,
  CASE WHEN first_excluded IS NOT NULL THEN 'EXCLUDED_STATUS_' || first_excluded
    WHEN NOT saw_default AND NOT saw_decided THEN 'AMBIGUOUS_ACTIVE_1_2_ARREARS' END AS exclusion_reason
FROM account_fact"""))
def default_flag(spark, d):
    position = F.when(F.col("in_45"), F.col("account_id")).otherwise(F.col("account_id") + (1 << 60))
    signals = acc.default_signals(F.col("status_code"), F.col("months_in_arrears"), position)
    rows = views.accounts(spark, d).filter("in_45 or in_49").groupBy("applicant_id").agg(
        *[s.alias(n) for n, s in signals.items()])
    return rows.select("applicant_id", acc.default_flag().alias("default_flag"), acc.default_exclusion().alias("exclusion_reason"))


@query("max_successful_loan", sql("SELECT applicant_id, max_repaid AS max_successful_loan FROM account_fact"))
def max_successful_loan(spark, d):
    return views.accounts(spark, d).filter("in_45 or in_49").groupBy("applicant_id").agg(
        acc.max_repaid_loan(F.col("status_code"), F.col("opening_balance")).alias("max_successful_loan"))


@query("all_accounts", sql("""
SELECT applicant_id, 'agreement' AS kind, account_id, status_code, months_in_arrears, opening_balance FROM account WHERE in_45
UNION ALL SELECT applicant_id, 'mobile', account_id, status_code, months_in_arrears, opening_balance FROM account WHERE in_49"""))
def all_accounts(spark, d):
    """Agreements and mobile facilities as one list; a single scan instead of a union of two."""
    kinds = F.array_compact(F.array(F.when(F.col("in_45"), "agreement"), F.when(F.col("in_49"), "mobile")))
    return views.accounts(spark, d).select(
        "applicant_id", F.explode(kinds).alias("kind"), "account_id", "status_code", "months_in_arrears", "opening_balance")


@query("hit_status", sql("SELECT request_id, hit_status FROM applicant"))
def hit_status(spark, d):
    return views.applicants(spark, d).select(
        "request_id", facts.hit_status(F.col("status_45"), F.col("status_49")).alias("hit_status"))


@query("bin_features", sql(f"SELECT request_id, {', '.join(FEATURE_NAMES)} FROM raw_feature"))
def bin_features(spark, d):
    return facts.feature_table(spark, d, impute=False).select("request_id", *catalog.FEATURES)


@query("feature_vector", sql(f"SELECT request_id, hit_status, applicant_age_years, {', '.join(FEATURE_NAMES)} FROM feature"))
def feature_vector(spark, d):
    return facts.feature_table(spark, d).select("request_id", "hit_status", "applicant_age_years", *catalog.FEATURES)


_PROV = {
    "highest_delinquency_rating": "CASE hit_status WHEN 'HIT' THEN 'p45' WHEN 'THIN_FILE' THEN 'p49' ELSE 'no_record_default' END",
    "months_on_time_24m": "CASE hit_status WHEN 'HIT' THEN 'p45' WHEN 'THIN_FILE' THEN 'imputed_median' ELSE 'no_record_default' END",
    "has_judgement": "CASE hit_status WHEN 'HIT' THEN 'p45' WHEN 'THIN_FILE' THEN 'imputed_zero' ELSE 'no_record_default' END",
    "mobile_max_loan_ghs": "CASE WHEN has_49 THEN 'p49' WHEN hit_status = 'HIT' THEN 'imputed_zero' ELSE 'no_record_default' END",
    "has_charged_off": "CASE WHEN has_45 AND has_49 THEN 'p45+p49' WHEN has_45 THEN 'p45' WHEN has_49 THEN 'p49' ELSE 'no_record_default' END",
    "applicant_age": "CASE WHEN applicant_age_years IS NOT NULL THEN 'p45' ELSE 'missing' END",
    "identity_verified": "CASE WHEN has_45 AND national_id IS NOT NULL THEN 'p45' ELSE 'missing' END",
    "address_stability": "CASE hit_status WHEN 'HIT' THEN 'p45' WHEN 'THIN_FILE' THEN 'imputed_median' ELSE 'missing' END",
}


@query("feature_provenance", sql(
    "SELECT request_id, " + ", ".join(f"{e} AS src_{n}" for n, e in _PROV.items()) + " FROM fact"))
def feature_provenance(spark, d):
    vectors = facts.feature_table(spark, d)
    return vectors.select("request_id", *[F.col("provenance")[n].alias(f"src_{n}") for n in _PROV])


@query("policy_imputation", sql("""SELECT hit_status, has_49, count(*) AS n,
  count(*) FILTER (hit_status = 'THIN_FILE') AS months_imputed,
  count(*) FILTER (hit_status = 'HIT' AND NOT has_49) AS mobile_imputed,
  round(sum(months_on_time_24m), 4) AS months_sum, round(sum(mobile_loan_history_count), 4) AS mobile_sum
FROM feature GROUP BY 1, 2"""))
def policy_imputation(spark, d):
    source = F.col("provenance")
    return facts.feature_table(spark, d).groupBy("hit_status", "has_49").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(source["months_on_time_24m"] == "imputed_median").alias("months_imputed"),
        F.count_if(source["mobile_loan_history_count"] == "imputed_zero").alias("mobile_imputed"),
        F.round(F.sum("months_on_time_24m"), 4).alias("months_sum"),
        F.round(F.sum("mobile_loan_history_count"), 4).alias("mobile_sum"))


_MISSING = [n for n in FEATURE_NAMES]
_REQUIRED_SQL = [n for n in FEATURE_NAMES if n not in (
    "months_on_time_24m", "worst_arrears_24m", "current_streak_on_time", "product_diversity_score",
    "mobile_loan_history_count", "mobile_max_loan_ghs", "has_judgement", "num_bounced_cheques",
    "has_adverse_default", "address_stability")]


def _missing_sql(names):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in names) + ")"


def _missing_count(names):
    return " + ".join(f"CAST({n} IS NULL AS INTEGER)" for n in names)


@query("feature_coverage", sql(f"""SELECT request_id, {_missing_sql(sorted(_MISSING))} AS missing_features,
  round((30 - ({_missing_count(_MISSING)})) / 30e0, 4) AS feature_coverage_ratio,
  {_missing_sql(_REQUIRED_SQL)} AS required_missing FROM feature"""))
def feature_coverage(spark, d):
    return features.coverage(facts.feature_table(spark, d)).select(
        "request_id", F.array_join("missing_features", ",").alias("missing_features"), "feature_coverage_ratio",
        F.array_join("required_missing", ",").alias("required_missing"))


@query("credit_score", sql("""SELECT request_id, round(group_a, 6) AS group_a, round(group_b, 6) AS group_b,
  round(group_c, 6) AS group_c, round(group_d, 6) AS group_d, round(group_e, 6) AS group_e, round(group_f, 6) AS group_f,
  raw_score FROM raw_scored"""))
def credit_score(spark, d):
    vectors = facts.feature_table(spark, d)
    groups = scoring.group_scores(features.feature_columns(), F.col("applicant_age_years"))
    return vectors.select(
        "request_id", *[F.round(g, 6).alias(f"group_{k.lower()}") for k, g in groups.items()],
        scoring.credit_score(groups).alias("raw_score"))


@query("score_grade", sql(f"""SELECT request_id, {GRADE.format(s='raw_score')} AS score_grade,
  {TIER.format(s='raw_score')} AS risk_tier FROM raw_scored"""))
def score_grade(spark, d):
    groups = scoring.group_scores(features.feature_columns(), F.col("applicant_age_years"))
    score = facts.feature_table(spark, d).select("request_id", scoring.credit_score(groups).alias("s"))
    return score.select("request_id", scoring.score_grade(F.col("s")).alias("score_grade"),
                        scoring.score_tier(F.col("s")).alias("risk_tier"))


@query("hard_stops", sql("""SELECT request_id, stop_code AS hard_stop_code,
  CASE WHEN stop_code IS NOT NULL THEN 'DECLINE' END AS hard_stop_decision FROM raw_scored"""))
def hard_stops(spark, d):
    code = scoring.hard_stop_code(features.feature_columns(), F.col("applicant_age_years"))
    return facts.feature_table(spark, d).select("request_id", code.alias("hard_stop_code"),
                                                scoring.hard_stop_decision(code).alias("hard_stop_decision"))


@query("matrix_decision", sql("SELECT request_id, grade, matrix_decision FROM matrix"))
def matrix_decision(spark, d):
    groups = scoring.group_scores(features.feature_columns(), F.col("applicant_age_years"))
    graded = facts.feature_table(spark, d).select(
        "request_id", "hit_status", scoring.score_grade(scoring.credit_score(groups)).alias("grade"))
    return graded.select("request_id", "grade",
                         scoring.matrix_decision(F.col("grade"), F.col("hit_status")).alias("matrix_decision"))


@query("rule_reasons", sql("""SELECT request_id, decision_reason_codes, condition_applied FROM scored
WHERE stop_code IS NULL"""))
def rule_reasons(spark, d):
    return facts.decisions(spark, d).filter("not hard_stop_triggered").select(
        "request_id", F.array_join("decision_reason_codes", ",").alias("decision_reason_codes"), "condition_applied")


def package_columns():
    return ["request_id", "hit_status", "hard_stop_code", "credit_score", "score_grade", "risk_tier", "decision",
            F.array_join("decision_reason_codes", ",").alias("decision_reason_codes"), "condition_applied"]


@query("decision_package", sql("""SELECT request_id, hit_status, stop_code AS hard_stop_code, credit_score, score_grade, risk_tier,
  decision, decision_reason_codes, condition_applied FROM scored"""))
def decision_package(spark, d):
    return facts.decisions(spark, d).select(*package_columns())


@query("decision_inference", sql(f"""SELECT request_id, closed OR stop_code IS NOT NULL AS hard_stop_triggered,
  CASE WHEN closed THEN 'FEATURE_VALIDATION_FAILED' ELSE stop_code END AS hard_stop_code,
  CASE WHEN closed THEN 300 ELSE credit_score END AS credit_score,
  CASE WHEN closed THEN 'F' ELSE score_grade END AS score_grade,
  CASE WHEN closed THEN 'DECLINE' ELSE decision END AS decision
FROM (SELECT *, ({_missing_count(_REQUIRED_SQL)}) > 0 AS closed FROM scored)"""))
def decision_inference(spark, d):
    """The same package for live requests: a missing required feature fails closed."""
    return facts.decisions(spark, d, flow="inference").select(
        "request_id", "hard_stop_triggered", "hard_stop_code", "credit_score", "score_grade", "decision")


_PROXY = """(0.40e0 * coalesce(total_monthly_instalment_ghs, 0e0) + 0.35e0 * coalesce(utilisation_ratio, 0e0)
  + 0.25e0 * (CASE WHEN applicant_age_years > 0 THEN least(applicant_age_years, 75) / 75e0 ELSE 0e0 END)
  + CASE WHEN employed THEN 0.10e0 ELSE 0e0 END)"""
_INCOME = f"""SELECT *, CASE WHEN proxy < 0.35e0 THEN 'LOW' WHEN proxy < 0.55e0 THEN 'MID' WHEN proxy < 0.75e0 THEN 'UPPER_MID' ELSE 'HIGH' END AS income_tier_proxy,
  round(least(greatest((CASE WHEN hit_status = 'NO_RECORD' THEN 0.4e0 ELSE 0.55e0 END) + (CASE WHEN employed THEN 0.1e0 ELSE 0e0 END)
    - (CASE WHEN applicant_age_years > 0 THEN 0e0 ELSE 0.2e0 END), 0e0), 1e0), 2) AS income_confidence
FROM (SELECT *, {_PROXY} AS proxy FROM (SELECT *, has_employer AND hit_status <> 'NO_RECORD' AS employed FROM scored))"""


def _with_income(vectors):
    employed = F.col("has_employer") & (F.col("has_45") | F.col("has_49"))
    tier, confidence = features.income_proxy(
        F.col("applicant_age_years"), employed, features.product_source(),
        F.col("total_monthly_instalment_ghs"), F.col("utilisation_ratio"))
    return vectors.withColumns({"income_tier_proxy": tier, "income_confidence": confidence})


@query("income_proxy", sql("SELECT request_id, income_tier_proxy, income_confidence FROM income", income=_INCOME))
def income_proxy(spark, d):
    return _with_income(facts.feature_table(spark, d)).select("request_id", "income_tier_proxy", "income_confidence")


_FLAG = ("CASE WHEN first_excluded IS NOT NULL OR n_accounts = 0 THEN NULL WHEN saw_default THEN 1 WHEN saw_decided THEN 0 END")


@query("targets", sql(f"""SELECT request_id, {_FLAG} AS default_flag,
  CASE WHEN n_accounts = 0 THEN 'NO_ACCOUNTS' WHEN first_excluded IS NOT NULL THEN 'EXCLUDED_STATUS_' || first_excluded
    WHEN NOT saw_default AND NOT saw_decided THEN 'AMBIGUOUS_ACTIVE_1_2_ARREARS' END AS default_flag_exclusion_reason,
  max_repaid AS max_successful_loan_ghs,
  CASE income_tier_proxy WHEN 'LOW' THEN 0 WHEN 'MID' THEN 1 WHEN 'UPPER_MID' THEN 2 ELSE 3 END AS income_tier
FROM income""", income=_INCOME))
def targets(spark, d):
    return training_rows(spark, d).select(
        "request_id", "default_flag", "default_flag_exclusion_reason", "max_successful_loan_ghs", "income_tier")


def training_rows(spark, d):
    """Features, targets and metadata of every applicant."""
    scored = _with_income(facts.decisions(spark, d))
    return features.coverage(scored).withColumns({
        "default_flag": acc.default_flag(),
        "default_flag_exclusion_reason": acc.default_exclusion(),
        "max_successful_loan_ghs": F.col("max_repaid"),
        "income_tier": features.income_class(F.col("income_tier_proxy")),
        "product_source": features.product_source(),
        "product_mix": features.product_mix(),
        "credit_age_months_at_application": features.months_from_weight(F.col("credit_age_months")),
        "bureau_hit_status_code": F.when(F.col("hit_status") == "HIT", F.lit(2))
        .when(F.col("hit_status") == "THIN_FILE", F.lit(1)).otherwise(0),
    })


@query("row_metadata", sql(f"""SELECT request_id,
  CASE WHEN hit_status = 'HIT' AND has_49 THEN '45+49' WHEN hit_status = 'HIT' THEN '45' WHEN hit_status = 'THIN_FILE' THEN '49' ELSE 'NONE' END AS product_source,
  CASE WHEN has_45 AND has_49 THEN '45_and_49' WHEN has_45 THEN '45_only' WHEN has_49 THEN '49_only' ELSE 'none' END AS product_mix,
  CASE hit_status WHEN 'HIT' THEN 2 WHEN 'THIN_FILE' THEN 1 ELSE 0 END AS bureau_hit_status_code,
  credit_score, score_grade, decision AS decision_label,
  CASE WHEN credit_age_months IS NULL THEN 0 WHEN credit_age_months >= 1 THEN 85 WHEN credit_age_months >= 0.85e0 THEN 60
    WHEN credit_age_months >= 0.65e0 THEN 36 WHEN credit_age_months >= 0.4e0 THEN 18 ELSE 6 END AS credit_age_months_at_application,
  round((30 - ({_missing_count(_MISSING)})) / 30e0, 4) AS feature_coverage_ratio,
  ({_FLAG}) IS NULL AS target_excluded FROM scored"""))
def row_metadata(spark, d):
    return training_rows(spark, d).select(
        "request_id", "product_source", "product_mix", "bureau_hit_status_code", "credit_score", "score_grade",
        F.col("decision").alias("decision_label"), "credit_age_months_at_application", "feature_coverage_ratio",
        F.col("default_flag").isNull().alias("target_excluded"))
