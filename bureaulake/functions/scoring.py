"""Feature vector to score, grade, hard stop and rule decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions.bins import bin_value, case


def zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def mean_of(*values: Column) -> Column:
    """Mean where a missing value counts as 0, clamped to [0, 1]."""
    return clamp(reduce(lambda a, b: a + b, [zero(v) for v in values]) / len(values), 0.0, 1.0)


def age_weight(age_years: Column) -> Column:
    return bin_value("applicant_age", age_years)


def derogatory_score(features: dict[str, Column], bounced: Column | None = None) -> Column:
    """Group D: 1 minus deductions.

    By default the *weight* of bounced cheques is truncated and read as a count, the behaviour that existing
    scores rely on.  Pass the raw count as ``bounced`` to deduct by the real number.
    """
    def flagged(name):
        return zero(features[name]).cast("int") == 1

    count = zero(features["num_bounced_cheques"]).cast("int") if bounced is None else bounced
    deductions = (
        F.when(flagged("has_charged_off"), F.lit(120.0 / 550)).otherwise(0.0),
        F.when(flagged("has_legal_handover"), F.lit(80.0 / 550)).otherwise(0.0),
        F.when(flagged("has_adverse_default"), F.lit(100.0 / 550)).otherwise(0.0),
        case([(count == 1, 20.0 / 550), (count == 2, 50.0 / 550), (count >= 3, 100.0 / 550)], 0.0),
    )
    return clamp(reduce(lambda acc, d: acc - d, deductions, F.lit(1.0)), 0.0, 1.0)


def group_scores(features: dict[str, Column], age_years: Column, bounced: Column | None = None) -> dict[str, Column]:
    def pick(group, skip=()):
        return [features[n] for n in catalog.FEATURE_GROUPS[group] if n not in skip]

    return {
        "A": mean_of(*pick("A")),
        "B": mean_of(*pick("B")),
        "C": mean_of(*pick("C", skip=("mobile_max_loan_ghs",))),
        "D": derogatory_score(features, bounced),
        "E": mean_of(*pick("E", skip=("enquiry_reason_flags",))),
        "F": mean_of(age_weight(age_years), *pick("F", skip=("applicant_age",))),
    }


def credit_score(groups: dict[str, Column]) -> Column:
    """300..850 from the weighted groups, rounded half to even."""
    weighted = reduce(lambda a, b: a + b, [F.lit(w) * groups[g] for g, w in catalog.GROUP_WEIGHTS.items()])
    return F.bround(F.lit(300.0) + F.lit(550.0) * clamp(weighted, 0.0, 1.0), 0).cast("int")


def band(value: Column, steps, otherwise) -> Column:
    return case([(value >= cut, label) for cut, label in steps], otherwise)


def score_grade(score: Column) -> Column:
    return band(score, catalog.SCORE_GRADES, catalog.LOWEST_GRADE)


def score_tier(score: Column) -> Column:
    """Risk tier by score; unlike the tier by default probability it has no LOW_MEDIUM."""
    return band(score, catalog.SCORE_TIERS, catalog.LOWEST_TIER)


def hard_stop_code(features: dict[str, Column], age_years: Column, fraud_high: Column | None = None,
                   multiple_arrears: Column | None = None, raw_delinquency: Column | None = None) -> Column:
    """First hard stop that applies, or null.

    ``fraud_high``, ``multiple_arrears`` and ``raw_delinquency`` are optional inputs; without the last the
    delinquency rule sees the bin weight, which never reaches its limit.
    """
    def is_one(name):
        return zero(features[name]).cast("int") == 1

    never = F.lit(False)
    rating = zero(features["highest_delinquency_rating"]) if raw_delinquency is None else raw_delinquency
    return case([
        (age_years.isNotNull() & ((age_years < 18) | (age_years > 75)), "AGE_INELIGIBLE"),
        (never if fraud_high is None else fraud_high, "FRAUD_HIGH"),
        (features["identity_verified"].cast("int") == 0, "KYC_FAIL"),
        (is_one("has_judgement"), "LEGAL_HOLD"),
        (is_one("has_written_off"), "WRITE_OFF_HISTORY"),
        (rating >= 4, "DELINQUENCY_CRITICAL"),
        (never if multiple_arrears is None else multiple_arrears, "MULTIPLE_ARREARS"),
    ])


def hard_stop_decision(code: Column) -> Column:
    return F.when(code == "FRAUD_HIGH", F.lit("FRAUD_HOLD")).when(code.isNotNull(), F.lit("DECLINE"))


def matrix_decision(grade: Column, hit_status: Column) -> Column:
    thin = hit_status == "THIN_FILE"
    return case([
        (hit_status == "NO_RECORD", "REFER"),
        (thin & grade.isin("A", "B", "C", "D"), "CONDITIONAL_APPROVE"),
        (~thin & grade.isin("A", "B", "C"), "APPROVE"),
        (~thin & (grade == "D"), "CONDITIONAL_APPROVE"),
        (grade == "E", "REFER"),
    ], "DECLINE")


def rule_condition(decision: Column, age_years: Column, debt_service: Column) -> Column:
    conditional = decision == "CONDITIONAL_APPROVE"
    return case([
        (conditional & (zero(debt_service) > 0.5), "CA-01"),
        (conditional & (F.coalesce(age_years, F.lit(0)) > 65), "CA-02"),
        (conditional, "CA-05"),
    ])


def rule_reasons(features: dict[str, Column], coverage: Column, debt_service: Column, decision: Column) -> Column:
    """Reason codes in fixed order, five at most."""
    def low(name, limit):
        return F.coalesce(features[name], F.lit(1.0)) < limit

    codes = F.array_compact(F.array(
        F.when(low("highest_delinquency_rating", 0.5), "R01"),
        F.when(low("utilisation_ratio", 0.5), "R02"),
        F.when(F.coalesce(coverage, F.lit(1.0)) < 0.6, "R03"),
        F.when(low("total_outstanding_debt_ghs", 0.35), "R04"),
        F.when(F.coalesce(features["num_enquiries_3m"], F.lit(1.0)) <= 0.35, "R05"),
        F.when(low("has_active_arrears", 1.0), "R06"),
        F.when(zero(debt_service) > 0.5, "R10"),
    ))
    approved = F.when(decision == "APPROVE", F.array(F.lit("R09"))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(codes) == 0, approved).otherwise(F.slice(codes, 1, 5))
