"""Model results and rule decision to the final decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions.bins import case
from bureaulake.functions.scoring import zero


def pd_tier(probability: Column) -> Column:
    """Risk tier by default probability; null outside [0, 1] so callers can report the row."""
    steps = [(probability < cut, label) for cut, label in catalog.PD_TIERS]
    return F.when((probability >= 0) & (probability <= 1), case(steps, "VERY_HIGH"))


def loan_tier(amount: Column) -> Column:
    return case([(amount < cut, label) for cut, label in catalog.LOAN_TIERS], catalog.TOP_LOAN_TIER)


def clamp_loan(amount: Column) -> Column:
    return F.greatest(F.lit(catalog.LOAN_FLOOR), F.least(amount, F.lit(catalog.LOAN_CEILING)))


def grade_decision(grade: Column) -> Column:
    return case([(F.upper(grade) == g, d) for g, (d, _, _) in catalog.GRADE_POLICY.items()])


def grade_loan_tier(grade: Column) -> Column:
    return case([(F.upper(grade) == g, t) for g, (_, t, _) in catalog.GRADE_POLICY.items() if t])


def grade_ceiling(grade: Column) -> Column:
    """Highest amount of the grade's loan tier; null where there is none."""
    return case([(F.upper(grade) == g, c) for g, (_, _, c) in catalog.GRADE_POLICY.items() if c])


def _rank(label: Column) -> Column:
    return case([(label == d, i) for i, d in enumerate(catalog.DECISIONS)])


def more_conservative(derived: Column, given: Column) -> Column:
    """The more conservative of two decisions; an unknown ``given`` label is ignored."""
    return F.when(_rank(given) < _rank(derived), given).otherwise(derived)


def soft_stops(features: dict[str, Column], score: Column, income_confidence: Column, quality: Column) -> Column:
    """Reasons that turn an approval into a referral."""
    return F.array_compact(F.array(
        F.when(F.coalesce(features["num_enquiries_3m"], F.lit(1.0)) <= 0.05,
               F.lit("Excessive bureau enquiries in last 3 months (credit shopping)")),
        F.when(F.coalesce(score, F.lit(0)).between(450, 519),
               F.lit("Borderline credit score (450-519) — requires analyst review")),
        F.when(income_confidence < 0.65, F.lit("Income verification confidence below 0.65")),
        F.when(F.coalesce(quality, F.lit(1.0)).between(0.60, 0.75),
               F.concat(F.lit("Data quality score marginal ("), F.format_string("%.2f", quality), F.lit(")"))),
    ))


def conditions(features: dict[str, Column], score: Column, age: Column, income_confidence: Column,
               amount: Column, grade: Column) -> Column:
    """Conditions CA-01..CA-06 with their text, in code order."""
    def feature(name):
        return zero(features[name])

    score, age = F.coalesce(score, F.lit(0)), F.coalesce(age, F.lit(0))
    ceiling = grade_ceiling(grade)
    unverified = F.coalesce(income_confidence < 0.65, F.lit(False)) & (score >= 600)
    return F.array_compact(F.array(
        F.when(amount > ceiling, F.concat(F.lit("CA-01: Loan amount capped at GHS "), F.format_number(ceiling, 2))),
        case([
            (age > 65, F.concat(F.lit("CA-02: Maximum tenor reduced due to applicant age ("), age, F.lit(")"))),
            (feature("total_monthly_instalment_ghs") > 0.7,
             F.lit("CA-02: Maximum tenor reduced due to elevated debt-service ratio")),
        ]),
        case([
            (score.between(520, 560) & (feature("num_closed_accounts_good") < 0.15), "CA-03: Guarantor required"),
            (feature("has_active_arrears") > 0.5, "CA-03: Guarantor required due to active arrears"),
        ]),
        F.when((amount > 100000) & (score < 700), F.lit("CA-04: Collateral documentation required")),
        case([
            (unverified, "CA-05: Income verification documents required within 5 business days"),
            (feature("has_employer_detail") < 0.5,
             "CA-05: Income verification documents required — no employer details on file"),
        ]),
        F.when((feature("num_active_accounts") > 0.6) & (feature("utilisation_ratio") > 0.7),
               F.lit("CA-06: First draw limited to 50% of approved amount")),
    ))


def final_decision(probability: Column, grade: Column, given: Column, fraud_flag: Column, features: dict[str, Column],
                   amount: Column, score: Column, age: Column, income_confidence: Column, quality: Column) -> dict[str, Column]:
    """The whole decision ladder as columns; every part is null-safe and row-local."""
    held = fraud_flag == "HIGH"
    resolved = more_conservative(grade_decision(grade), given)
    open_to_review = ~held & resolved.isin("APPROVE", "CONDITIONAL_APPROVE")
    none = F.array().cast("array<string>")
    reasons = F.when(open_to_review, soft_stops(features, score, income_confidence, quality)).otherwise(none)
    decided = case([(held, F.lit("FRAUD_HOLD")), (F.size(reasons) > 0, F.lit("REFER"))], resolved)
    extra = F.when(decided == "CONDITIONAL_APPROVE",
                   conditions(features, score, age, income_confidence, amount, grade)).otherwise(none)
    return {
        "decision": decided, "risk_tier": pd_tier(probability), "recommended_loan_tier": grade_loan_tier(grade),
        "refer_reasons": reasons, "conditions": extra,
    }


# --- model outputs -----------------------------------------------------------------------------------------


def platt(score: Column, a: float, b: float) -> Column:
    """Calibrated probability 1 / (1 + exp(-(a * score + b)))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * score + F.lit(b))))


def confidence(probability: Column) -> Column:
    return F.greatest(probability, F.lit(1.0) - probability)


def anomaly_score(raw: Column, low: Column, high: Column) -> Column:
    """0 at the most normal raw score, 1 at the most anomalous; 0.5 when all scores are equal."""
    scaled = F.lit(1.0) - (raw - low) / F.when(high > low, high - low)
    return F.when(high > low, F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))).otherwise(0.5)


def fraud_flag(raw: Column, p1: Column, p5: Column) -> Column:
    return case([(raw < p1, "HIGH"), (raw < p5, "MEDIUM")], "LOW")


def income_label(tier: Column) -> Column:
    return case([(tier == i, name) for i, name in enumerate(catalog.INCOME_TIERS)])


def best_class(probabilities: Column) -> tuple[Column, Column]:
    """(index, probability) of the largest entry, the first on ties."""
    top = F.array_max(probabilities)
    return (F.array_position(probabilities, top) - 1).cast("int"), top
