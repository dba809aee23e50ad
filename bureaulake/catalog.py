"""Fixed values of the credit-decision domain: features, cuts, labels, limits and policies.

Everything here is data.  Functions that turn these values into Spark expressions live in
``bureaulake.functions``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --------------------------------------------------------------------------------------
# The thirty features by group, in vector order.
# --------------------------------------------------------------------------------------
FEATURE_GROUPS = {
    "A": ["highest_delinquency_rating", "months_on_time_24m", "worst_arrears_24m", "current_streak_on_time",
          "has_active_arrears", "total_arrear_amount_ghs"],
    "B": ["total_outstanding_debt_ghs", "utilisation_ratio", "num_active_accounts", "total_monthly_instalment_ghs"],
    "C": ["credit_age_months", "num_accounts_total", "num_closed_accounts_good", "product_diversity_score",
          "mobile_loan_history_count", "mobile_max_loan_ghs"],
    "D": ["has_judgement", "has_written_off", "has_charged_off", "has_legal_handover", "num_bounced_cheques",
          "has_adverse_default"],
    "E": ["num_enquiries_3m", "num_enquiries_12m", "enquiry_reason_flags"],
    "F": ["applicant_age", "identity_verified", "num_dependants", "has_employer_detail", "address_stability"],
}
FEATURES = [name for names in FEATURE_GROUPS.values() for name in names]
GROUP_OF = {name: group for group, names in FEATURE_GROUPS.items() for name in names}

# Weight of each group in the score.
GROUP_WEIGHTS = {"A": 0.35, "B": 0.25, "C": 0.15, "D": 0.15, "E": 0.05, "F": 0.05}

# Features that exist in one product only, with the imputation strategy.
ONLY_45 = {
    "months_on_time_24m": "MEDIAN", "worst_arrears_24m": "ZERO", "current_streak_on_time": "MEDIAN",
    "product_diversity_score": "ZERO", "has_judgement": "ZERO", "num_bounced_cheques": "ZERO",
    "has_adverse_default": "ZERO", "address_stability": "MEDIAN",
}
ONLY_49 = {"mobile_loan_history_count": "ZERO", "mobile_max_loan_ghs": "ZERO"}
IMPUTABLE = {**ONLY_45, **ONLY_49}
MEDIAN_FEATURES = [f for f in FEATURES if IMPUTABLE.get(f) == "MEDIAN"]
ZERO_FEATURES = [f for f in FEATURES if IMPUTABLE.get(f) == "ZERO"]
REQUIRED_FEATURES = [f for f in FEATURES if f not in IMPUTABLE]

# Bootstrap policy values for the imputable features.
POLICY_VERSION = "de-imputation-v1-bootstrap"
POLICY_VALUES = {
    "months_on_time_24m": 0.55, "worst_arrears_24m": 0.0, "current_streak_on_time": 0.45,
    "product_diversity_score": 0.0, "has_judgement": 0.0, "num_bounced_cheques": 0.0, "has_adverse_default": 0.0,
    "address_stability": 0.75, "mobile_loan_history_count": 0.0, "mobile_max_loan_ghs": 0.0,
}

# Feature vector of an applicant without any bureau record.
NO_RECORD_DEFAULTS = {
    "highest_delinquency_rating": 0.00, "months_on_time_24m": 0.00, "worst_arrears_24m": 0.00,
    "current_streak_on_time": 0.20, "has_active_arrears": 0.00, "total_arrear_amount_ghs": 1.00,
    "total_outstanding_debt_ghs": 1.00, "utilisation_ratio": 1.00, "num_active_accounts": 0.15,
    "total_monthly_instalment_ghs": 1.00, "credit_age_months": 0.15, "num_accounts_total": 0.00,
    "num_closed_accounts_good": 0.10, "product_diversity_score": 0.30, "mobile_loan_history_count": 0.20,
    "mobile_max_loan_ghs": 0.00, "has_judgement": 0.00, "has_written_off": 0.00, "has_charged_off": 0.00,
    "has_legal_handover": 0.00, "num_bounced_cheques": 0.00, "has_adverse_default": 0.00, "num_enquiries_3m": 1.00,
    "num_enquiries_12m": 1.00, "enquiry_reason_flags": 0.00,
}


@dataclass(frozen=True)
class Ladder:
    """A step function: the first cut that holds gives the weight, else ``otherwise``.

    ``op`` is one of ``<=``, ``>=``, ``==``, ``>``; ``whole`` truncates the value first.
    """

    steps: tuple[tuple[str, float, float], ...]
    otherwise: float
    whole: bool = False


def _at_most(*pairs, otherwise, whole=False):
    return Ladder(tuple(("<=", cut, w) for cut, w in pairs), otherwise, whole)


def _at_least(*pairs, otherwise, whole=False):
    return Ladder(tuple((">=", cut, w) for cut, w in pairs), otherwise, whole)


# Bin weights per feature.
LADDERS = {
    "highest_delinquency_rating": Ladder(
        (("==", 0, 1.0), ("==", 1, 0.5), ("==", 2, 0.7), ("==", 3, 0.85), ("==", 4, 0.0)), 0.0, whole=True),
    "months_on_time_24m": _at_least((20, 1.0), (15, 0.8), (10, 0.55), (5, 0.25), otherwise=0.0),
    "worst_arrears_24m": _at_most((0, 1.0), (1, 0.7), (2, 0.4), (5, 0.15), otherwise=0.0),
    "current_streak_on_time": _at_least((12, 1.0), (6, 0.75), (3, 0.45), otherwise=0.2),
    "total_arrear_amount_ghs": _at_most((0, 1.0), (500, 0.7), (2000, 0.35), (10000, 0.1), otherwise=0.0),
    "total_outstanding_debt_ghs": _at_most((0, 1.0), (10000, 0.8), (50000, 0.6), (150000, 0.3), otherwise=0.05),
    "utilisation_ratio": _at_most((0.25, 1.0), (0.5, 0.8), (0.75, 0.5), (0.9, 0.2), otherwise=0.05),
    "num_active_accounts": _at_most((1, 0.85), (3, 1.0), (5, 0.55), otherwise=0.15, whole=True),
    "total_monthly_instalment_ghs": _at_most((500, 1.0), (2000, 0.85), (5000, 0.6), (15000, 0.3), otherwise=0.05),
    "credit_age_months": Ladder(((">", 84, 1.0), (">=", 48, 0.85), (">=", 24, 0.65), (">=", 12, 0.4)), 0.15),
    "num_accounts_total": _at_least((10, 1.0), (5, 0.8), (3, 0.55), (1, 0.3), otherwise=0.0, whole=True),
    "num_closed_accounts_good": _at_least((5, 1.0), (3, 0.75), (1, 0.45), otherwise=0.1),
    "product_diversity_score": _at_least((4, 1.0), (3, 0.8), (2, 0.55), (1, 0.3), otherwise=0.0),
    "mobile_loan_history_count": _at_least((20, 1.0), (10, 0.95), (5, 0.85), (1, 0.6), otherwise=0.2, whole=True),
    "mobile_max_loan_ghs": _at_most((0, 0.2), (500, 0.4), (2000, 0.6), (5000, 0.8), otherwise=1.0),
    "num_bounced_cheques": _at_most((0, 1.0), (1, 0.7), (2, 0.35), otherwise=0.05, whole=True),
    "num_enquiries_3m": _at_most((1, 1.0), (3, 0.75), (5, 0.35), otherwise=0.05),
    "num_enquiries_12m": _at_most((2, 1.0), (5, 0.8), (10, 0.4), otherwise=0.1),
    "num_dependants": Ladder((("==", 0, 1.0), ("<=", 2, 0.85), ("<=", 4, 0.65)), 0.4, whole=True),
    "address_stability": _at_most((1, 1.0), (2, 0.75), otherwise=0.4),
    "applicant_age": Ladder(
        (("<", 18, 0.0), (">", 75, 0.0), ("<=", 25, 0.7), ("<=", 40, 1.0), ("<=", 60, 0.9)), 0.65, whole=True),
}

# Account status codes.
ADVERSE_STATUS = ["W", "G", "L", "X"]
EXCLUDED_STATUS = ["D", "E", "RV"]
REPAID_STATUS = ["C", "P"]
SETTLED_STATUS = ["C", "P", "T"]
NOT_GOOD_STATUS = ["W", "G", "L", "X", "D"]
PAYMENT_GAP_CODES = ["", "#", "C", "P", "T", "RV"]

# Score bands.
SCORE_GRADES = [(750, "A"), (700, "B"), (650, "C"), (600, "D"), (520, "E")]
LOWEST_GRADE = "F"
SCORE_TIERS = [(750, "VERY_LOW"), (700, "LOW"), (600, "MEDIUM"), (520, "HIGH")]
LOWEST_TIER = "VERY_HIGH"
GRADES = ["A", "B", "C", "D", "E", "F"]

# Default-probability and loan-amount bands (upper bound exclusive).
PD_TIERS = [(0.05, "VERY_LOW"), (0.10, "LOW"), (0.15, "LOW_MEDIUM"), (0.20, "MEDIUM"), (0.40, "HIGH")]
LOAN_TIERS = [(5000.0, "MICRO"), (25000.0, "SMALL"), (100000.0, "MEDIUM"), (250000.0, "LARGE")]
TOP_LOAN_TIER = "PREMIUM"
LOAN_FLOOR, LOAN_CEILING = 500.0, 10000.0

# Grade -> (decision, highest loan tier, tier ceiling).
GRADE_POLICY = {
    "A": ("APPROVE", "PREMIUM", None), "B": ("APPROVE", "LARGE", 250000.0), "C": ("APPROVE", "MEDIUM", 100000.0),
    "D": ("CONDITIONAL_APPROVE", "SMALL", 25000.0), "E": ("REFER", "MICRO", 5000.0), "F": ("DECLINE", None, None),
}

# Decisions from most to least conservative.
DECISIONS = ["FRAUD_HOLD", "DECLINE", "REFER", "CONDITIONAL_APPROVE", "APPROVE"]

# Income classes.
INCOME_TIERS = ["LOW", "MID", "UPPER_MID", "HIGH"]

# Feature -> reason code shown with an explanation.
REASON_CODES = {
    "highest_delinquency_rating": "R01", "months_on_time_24m": "R01", "worst_arrears_24m": "R01",
    "current_streak_on_time": "R01", "utilisation_ratio": "R02", "credit_age_months": "R03",
    "num_accounts_total": "R03", "total_outstanding_debt_ghs": "R04", "total_monthly_instalment_ghs": "R04",
    "num_enquiries_3m": "R05", "num_enquiries_12m": "R05", "has_active_arrears": "R06",
    "total_arrear_amount_ghs": "R06", "has_employer_detail": "R07", "num_dependants": "R07",
    "has_adverse_default": "R08", "has_written_off": "R08", "has_charged_off": "R08", "has_legal_handover": "R08",
    "has_judgement": "R08", "product_diversity_score": "R09", "num_closed_accounts_good": "R09",
}
REASON_TEXT = {
    "R01": "Delinquency history", "R02": "High credit utilisation", "R03": "Limited credit history",
    "R04": "High outstanding debt", "R05": "Multiple recent enquiries", "R06": "Active arrears present",
    "R07": "Low income indicators", "R08": "Adverse account records", "R09": "Limited account diversity",
    "R10": "High monthly obligations",
}

# Model types.
MODELS = ["credit_risk", "fraud_detection", "loan_amount", "income_verification"]

# Fairness groups by the weight of the age bin, and limits.
AGE_GROUPS = {0.00: "INELIGIBLE", 0.70: "YOUNG", 1.00: "PRIME", 0.90: "MATURE", 0.65: "SENIOR"}
IMPACT_RATIO_MIN = 0.80
FNR_GAP_MAX = 0.10

# Drift limits.
PSI_MINOR, PSI_SIGNIFICANT = 0.10, 0.20
PSI_EPSILON = 1e-6
DRIFT_BINS = 10


@dataclass(frozen=True)
class AsOf:
    """Reference dates; the clock is never read inside a plan, so re-runs give the same rows."""

    accounts: dt.date = dt.date(2001, 12, 31)
    enquiries: dt.date = dt.date(2024, 4, 20)
    birth: dt.date = dt.date(2012, 6, 30)
