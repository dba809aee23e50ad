"""Applicant facts (one row per applicant) to the thirty-feature vector and everything derived from it.

The *facts* table has plain columns, one row per applicant::

    request_id, hit_status, has_45, has_49, applicant_age_years (null: unknown), dependants, has_employer,
    identity_known, delinquency (null: absent), accounts_in_arrear, arrear_amount, outstanding_debt, instalment_45, instalment_49,
    active_accounts, total_accounts, bounced_cheques, judgement_found (null: section absent), has_adverse,
    has_agreements (section present), months_on_time, worst_arrears, current_streak, utilisation,
    credit_age, closed_good, product_diversity, distinct_addresses, mobile_count, mobile_max,
    written_off, charged_off, legal_handover, enquiries_3m, enquiries_12m, enquiries_total

It is built either from relational bureau tables (``plans.facts``) or from nested reports
(``operators.reports``); the rules below are the same for both.  Texts are parsed before the facts are
joined, so the thirty feature expressions stay small wherever the optimizer moves them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import bins, parse, scoring
from bureaulake.functions.bins import bin_value, case

PRODUCT_45_BINS = {
    "months_on_time_24m": "months_on_time", "worst_arrears_24m": "worst_arrears",
    "current_streak_on_time": "current_streak", "total_arrear_amount_ghs": "arrear_amount",
    "total_outstanding_debt_ghs": "outstanding_debt", "num_active_accounts": "active_accounts",
    "num_accounts_total": "total_accounts", "credit_age_months": "credit_age",
    "num_closed_accounts_good": "closed_good", "product_diversity_score": "product_diversity",
    "num_bounced_cheques": "bounced_cheques", "address_stability": "distinct_addresses",
    "utilisation_ratio": "utilisation",
}


def age_years(birth_date: Column, as_of: dt.date) -> Column:
    """Age at ``as_of``; null when unknown or not positive."""
    age = parse.age_in_years(parse.day_first_date(birth_date), as_of)
    return F.when(age > 0, age)


def _sources() -> dict[str, list[tuple[Column, Column, Column]]]:
    """Per feature: (condition, value, source) in order of precedence."""
    col = F.col
    hit, thin = col("hit_status") == "HIT", col("hit_status") == "THIN_FILE"
    p45, p49 = col("has_45"), col("has_49")
    from_45, from_49 = F.lit("p45"), F.lit("p49")
    either = F.when(p45 & p49, F.lit("p45+p49")).when(p45, from_45).otherwise(from_49)

    rules = {f: [(hit, bin_value(f, col(c)), from_45)] for f, c in PRODUCT_45_BINS.items()}
    rating = bin_value("highest_delinquency_rating", col("delinquency"))
    rules["highest_delinquency_rating"] = [
        (hit & col("delinquency").isNotNull(), rating, from_45), (thin, rating, from_49)]
    rules["has_active_arrears"] = [
        (hit & col("accounts_in_arrear").isNotNull(), bins.no_yes(col("accounts_in_arrear") > 0), from_45)]
    rules["has_judgement"] = [(hit & col("judgement_found").isNotNull(), bins.yes_no(col("judgement_found")), from_45)]
    rules["has_adverse_default"] = [(hit, bins.yes_no(col("has_adverse")), from_45)]
    dependants = bin_value("num_dependants", col("dependants"))
    rules["num_dependants"] = [(hit, dependants, from_45), (thin, dependants, from_49)]
    employer = bins.employer_weight(col("has_employer"))
    rules["has_employer_detail"] = [(hit, employer, from_45), (thin, employer, from_49)]
    for feature, fact in (("mobile_loan_history_count", "mobile_count"), ("mobile_max_loan_ghs", "mobile_max")):
        rules[feature] = [(p49, bin_value(feature, col(fact)), from_49)]
    instalments = (F.when(p45, scoring.zero(col("instalment_45"))).otherwise(0.0)
                   + F.when(p49, scoring.zero(col("instalment_49"))).otherwise(0.0))
    rules["total_monthly_instalment_ghs"] = [
        (p45 | p49, bin_value("total_monthly_instalment_ghs", instalments), either)]
    rules["has_written_off"] = [
        (p49 | (p45 & col("has_agreements")), bins.yes_no(col("written_off")), either)]
    rules["has_charged_off"] = [(p45 | p49, bins.yes_no(col("charged_off")), either)]
    rules["has_legal_handover"] = [(p45 | p49, bins.yes_no(col("legal_handover")), either)]
    rules["identity_verified"] = [(p45 & col("identity_known"), F.lit(1.0), from_45)]
    rules["applicant_age"] = [
        (p45 & col("applicant_age_years").isNotNull(), bin_value("applicant_age", col("applicant_age_years")), from_45)]
    for feature, fact in (("num_enquiries_3m", "enquiries_3m"), ("num_enquiries_12m", "enquiries_12m")):
        value = bin_value(feature, col(fact))
        rules[feature] = [(p45, value, from_45), (thin, value, from_49)]
    asked = bins.yes_no(F.coalesce(col("enquiries_total"), F.lit(0)) > 0)
    rules["enquiry_reason_flags"] = [(p45, asked, from_45), (thin, asked, from_49)]

    no_record = col("hit_status") == "NO_RECORD"
    for feature, value in catalog.NO_RECORD_DEFAULTS.items():
        rules[feature].append((no_record, F.lit(value), F.lit("no_record_default")))
    return rules


def _gap(feature: str) -> Column | None:
    """Where the product that carries the feature is absent."""
    if feature in catalog.ONLY_49:
        return (F.col("hit_status") == "HIT") & ~F.col("has_49")
    if feature in catalog.ONLY_45:
        return F.col("hit_status") == "THIN_FILE"
    return None


def feature_vector(facts: DataFrame, policy: dict[str, float] | None = None, impute: bool = True) -> DataFrame:
    """Facts plus 30 feature columns and ``provenance`` (feature -> source).

    One projection, no shuffle.  ``policy`` maps the imputable features to fill values.
    """
    policy = catalog.POLICY_VALUES if policy is None else policy
    values, sources = [], []
    for feature, rules in _sources_ordered():
        rules = list(rules)
        gap = _gap(feature)
        if impute and gap is not None and policy.get(feature) is not None:
            tag = "imputed_zero" if catalog.IMPUTABLE[feature] == "ZERO" else "imputed_median"
            rules.append((gap, F.lit(float(policy[feature])), F.lit(tag)))
        values.append(case([(c, v) for c, v, _ in rules]).cast("double").alias(feature))
        sources += [F.lit(feature), case([(c, s) for c, _, s in rules], "missing")]
    return facts.select("*", *values, F.create_map(*sources).alias("provenance"))


def _sources_ordered():
    rules = _sources()
    return [(feature, rules[feature]) for feature in catalog.FEATURES]


def feature_columns() -> dict[str, Column]:
    return {f: F.col(f) for f in catalog.FEATURES}


def missing_features(names=None) -> Column:
    """Names of the null features, in vector order."""
    names = catalog.FEATURES if names is None else names
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in names]))


def coverage(vectors: DataFrame) -> DataFrame:
    """Missing list, coverage ratio and missing required features per row."""
    missing = missing_features()
    return vectors.withColumns({
        "missing_features": F.array_sort(missing),
        "feature_coverage_ratio": F.round((F.lit(30) - F.size(missing)) / 30, 4),
        "required_missing": missing_features(catalog.REQUIRED_FEATURES),
    })


def product_source() -> Column:
    return case([
        ((F.col("hit_status") == "HIT") & F.col("has_49"), "45+49"),
        (F.col("hit_status") == "HIT", "45"),
        (F.col("hit_status") == "THIN_FILE", "49"),
    ], "NONE")


def product_mix() -> Column:
    hit, p49 = F.col("hit_status") == "HIT", F.col("has_49")
    return case([(hit & p49, "45_and_49"), (hit, "45_only"), (p49, "49_only")], "none")


def months_from_weight(weight: Column) -> Column:
    """Representative months for a credit-age bin weight."""
    # Weight floor -> months.
    steps = [(1.0, 85), (0.85, 60), (0.65, 36), (0.40, 18)]
    return F.when(weight.isNull(), F.lit(0)).otherwise(scoring.band(weight, steps, 6))


def score(vectors: DataFrame, flow: str = "training", fix_polarity: bool = False,
          raw_delinquency_stop: bool = False) -> DataFrame:
    """Adds the decision package: hard stop, score, grade, tier, decision, reasons and condition.

    ``flow='inference'`` fails closed: a row with a required feature missing is declined.
    ``fix_polarity`` deducts by the real number of bounced cheques, ``raw_delinquency_stop`` lets the
    delinquency hard stop see the raw rating; both are off to keep existing results.
    """
    features = feature_columns()
    age = F.col("applicant_age_years")
    bounced = F.col("bounced_cheques") if fix_polarity else None
    groups = scoring.group_scores(features, age, bounced)
    raw = scoring.zero(F.col("delinquency")) if raw_delinquency_stop else None
    no_ratio = F.lit(None).cast("double")

    scored = vectors.withColumns({
        "raw_score": scoring.credit_score(groups),
        "hard_stop_code": scoring.hard_stop_code(features, age, raw_delinquency=raw),
        "_closed": (F.size(missing_features(catalog.REQUIRED_FEATURES)) > 0) if flow == "inference" else F.lit(False),
    })
    stopped = F.col("_closed") | F.col("hard_stop_code").isNotNull()
    scored = scored.withColumns({
        "hard_stop_triggered": stopped,
        "credit_score": F.when(stopped, F.lit(300)).otherwise(F.col("raw_score")),
        "_matrix": scoring.matrix_decision(scoring.score_grade(F.col("raw_score")), F.col("hit_status")),
        "hard_stop_code": F.when(F.col("_closed"), F.lit("FEATURE_VALIDATION_FAILED")).otherwise(F.col("hard_stop_code")),
    })
    stopped, code = F.col("hard_stop_triggered"), F.col("hard_stop_code")
    return scored.withColumns({
        "score_grade": scoring.score_grade(F.col("credit_score")),
        "risk_tier": scoring.score_tier(F.col("credit_score")),
        "decision": F.when(stopped, scoring.hard_stop_decision(code)).otherwise(F.col("_matrix")),
        "decision_reason_codes": F.when(stopped, F.array(code)).otherwise(
            scoring.rule_reasons(features, no_ratio, no_ratio, F.col("_matrix"))),
        "condition_applied": F.when(~stopped, scoring.rule_condition(F.col("_matrix"), age, no_ratio)),
    }).drop("_closed", "_matrix")


def income_proxy(age: Column, has_employer: Column, source: Column, instalment: Column, utilisation: Column,
                 debt_service: Column | None = None) -> tuple[Column, Column]:
    """(income tier label, confidence) from bureau signals only."""
    employed = F.coalesce(has_employer, F.lit(False))
    known_age = F.coalesce(age, F.lit(0)) > 0
    part = F.when(known_age, F.least(age, F.lit(75)) / F.lit(75.0)).otherwise(0.0)
    proxy = (F.lit(0.40) * scoring.zero(instalment) + F.lit(0.35) * scoring.zero(utilisation) + F.lit(0.25) * part
             + F.when(employed, F.lit(0.10)).otherwise(0.0))
    by_proxy = case([(proxy < 0.35, "LOW"), (proxy < 0.55, "MID"), (proxy < 0.75, "UPPER_MID")], "HIGH")
    ratio = scoring.zero(debt_service) if debt_service is not None else F.lit(0.0)
    income = F.lit(1.0) / F.when(ratio > 0, ratio) * F.when(employed, F.lit(0.35)).otherwise(0.30) * 1000
    by_ratio = case([(income < 2000, "LOW"), (income <= 10000, "MID"), (income <= 25000, "UPPER_MID")], "HIGH")
    tier = F.when(ratio > 0, by_ratio).otherwise(by_proxy)
    base = case([(source == "NONE", 0.4), (source == "49", 0.55), (ratio > 0, 0.75)], 0.55)
    confidence = (base + F.when(employed, F.lit(0.1)).otherwise(0.0)
                  - F.when(known_age, F.lit(0.0)).otherwise(0.2))
    return tier, F.round(scoring.clamp(confidence, 0.0, 1.0), 2)


def income_class(label: Column) -> Column:
    return case([(label == name, i) for i, name in enumerate(catalog.INCOME_TIERS)])
