"""Boundary tables of the scalar rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import bins, decision, parse, scoring
from bureaulake.operators import features, monitoring


@pytest.mark.parametrize("feature, values, expected", [
    ("months_on_time_24m", [20, 19, 15, 14, 10, 9, 5, 4], [1, .8, .8, .55, .55, .25, .25, 0]),
    ("worst_arrears_24m", [-1, 0, 1, 2, 3, 5, 6], [1, 1, .7, .4, .15, .15, 0]),
    ("current_streak_on_time", [12, 11, 6, 5, 3, 2], [1, .75, .75, .45, .45, .2]),
    ("total_arrear_amount_ghs", [0, .5, 500, 500.5, 2000, 10000, 10001], [1, .7, .7, .35, .35, .1, 0]),
    ("utilisation_ratio", [.25, .251, .5, .75, .9, 1.2], [1, .8, .8, .5, .2, .05]),
    ("credit_age_months", [85, 84, 48, 47, 24, 12, 11], [1, .85, .85, .65, .65, .4, .15]),
    ("num_active_accounts", [0, 1.9, 2, 3, 5, 6], [.85, .85, 1, 1, .55, .15]),
    ("num_dependants", [0, 1, 2, 4, 5], [1, .85, .85, .65, .4]),
    ("applicant_age", [17, 18, 25, 26, 40, 41, 60, 61, 75, 76], [0, .7, .7, 1, 1, .9, .9, .65, .65, 0]),
    ("highest_delinquency_rating", [0, 1, 2, 3, 4, 5], [1, .5, .7, .85, 0, 0]),
    ("mobile_max_loan_ghs", [0, 500, 2000, 5000, 5001], [.2, .4, .6, .8, 1]),
    ("num_enquiries_12m", [2, 5, 10, 11], [1, .8, .4, .1]),
])
def test_bin_boundaries(column, feature, values, expected):
    assert column(bins.BINNERS[f"bin_{feature}"], [float(v) for v in values]) == pytest.approx(expected)


def test_bins_are_total_and_in_range(column):
    values = [None, -1e12, -1.0, 0.0, 0.3, 1.0, 7.0, 99.0, 1e5, 1e12]
    for name, binner in bins.BINNERS.items():
        out = column(binner, values)
        assert all(w is not None and 0 <= w <= 1 for w in out), name


def test_pd_tier_boundaries(column):
    assert column(decision.pd_tier, [0.0, 0.049999, 0.05, 0.1, 0.15, 0.2, 0.4, 1.0, 1.01, -0.1]) == [
        "VERY_LOW", "VERY_LOW", "LOW", "LOW_MEDIUM", "MEDIUM", "HIGH", "VERY_HIGH", "VERY_HIGH", None, None]


def test_loan_tier_and_clamp(column):
    assert column(decision.loan_tier, [0.0, 4999.99, 5000.0, 25000.0, 100000.0, 250000.0]) == [
        "MICRO", "MICRO", "SMALL", "MEDIUM", "LARGE", "PREMIUM"]
    assert column(decision.clamp_loan, [100.0, 7000.0, 20000.0]) == [500.0, 7000.0, 10000.0]


def test_score_bands(column):
    assert column(scoring.score_grade, [750, 749, 700, 650, 600, 520, 519], "int") == list("ABBCDEF")
    assert "LOW_MEDIUM" not in column(scoring.score_tier, list(range(300, 851, 10)), "int")


@pytest.mark.parametrize("text, number", [("1,250.50", 1250.5), (" 7 ", 7.0), ("", 0.0), ("n/a", 0.0), (None, 0.0), ("1d", 0.0), ("-3", -3.0)])
def test_safe_number(column, text, number):
    assert column(parse.safe_number, [text], "string") == [number]


def test_dates(column):
    found = column(parse.parse_date, ["05/02/2001", "2001/2/5 10:00", "2001-02-05", "31/02/2001", "5 Feb", "", None], "string")
    assert [str(v) if v else None for v in found] == ["2001-02-05"] * 3 + [None] * 4
    assert column(parse.date_layout, ["03/04/2020", "13/04/2020", "13.04.2020", "2020-13-01"], "string") == [
        "US_SLASH", "EU_SLASH", "EU_DOT", None]


def test_age_needs_a_completed_year(spark):
    import datetime as dt

    row = spark.range(1).select(*[parse.age_in_years(F.lit(dt.date(1990, 6, d)), dt.date(2012, 6, 15)).alias(f"d{d}") for d in (14, 15, 16)]).first()
    assert tuple(row) == (22, 22, 21)


def test_more_conservative_decision_wins(spark):
    pairs = [(a, b) for a in catalog.DECISIONS for b in [*catalog.DECISIONS, "UNKNOWN"]]
    out = spark.createDataFrame(pairs, "a string, b string").withColumn("r", decision.more_conservative(F.col("a"), F.col("b"))).collect()
    rank = {d: i for i, d in enumerate(catalog.DECISIONS)}
    for a, b, r in out:
        assert rank[r] == min(rank[a], rank.get(b, 99))


def engine(spark, **given):
    base = {"pd": 0.1, "grade": "D", "label": "CONDITIONAL_APPROVE", "flag": "LOW", "amount": 1000.0, "score": 620, "age": 40,
            "confidence": 0.9, "quality": 0.9, **{f: 0.5 for f in catalog.FEATURES}}
    base.update(given)
    kinds = {str: "string", int: "int", float: "double", type(None): "double"}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{n} {kinds[type(v)]}" for n, v in base.items()))
    c = F.col
    found = decision.final_decision(c("pd"), c("grade"), c("label"), c("flag"), {f: c(f) for f in catalog.FEATURES}, c("amount"),
                                    c("score"), c("age"), c("confidence"), c("quality"))
    return df.select(*[v.alias(n) for n, v in found.items()]).first()


@pytest.mark.parametrize("given, code", [
    ({"amount": 25001.0}, "CA-01"), ({"age": 66}, "CA-02"), ({"total_monthly_instalment_ghs": 0.71}, "CA-02"),
    ({"score": 540, "num_closed_accounts_good": 0.1}, "CA-03"), ({"has_active_arrears": 1.0}, "CA-03"),
    ({"amount": 100001.0, "grade": "D"}, "CA-04"), ({"has_employer_detail": 0.4}, "CA-05"),
    ({"num_active_accounts": 0.85, "utilisation_ratio": 0.8}, "CA-06"),
])
def test_conditions(spark, given, code):
    row = engine(spark, **given)
    assert row["decision"] == "CONDITIONAL_APPROVE" and any(c.startswith(code) for c in row["conditions"])


def test_no_condition_without_trigger(spark):
    assert engine(spark)["conditions"] == []


def test_fraud_hold_and_soft_stops(spark):
    held = engine(spark, flag="HIGH", confidence=0.1)
    assert held["decision"] == "FRAUD_HOLD" and held["refer_reasons"] == [] and held["recommended_loan_tier"] == "SMALL"
    for given in ({"num_enquiries_3m": 0.05}, {"score": 500}, {"confidence": 0.64}, {"quality": 0.7}):
        row = engine(spark, **given)
        assert row["decision"] == "REFER" and len(row["refer_reasons"]) == 1 and row["conditions"] == []
    assert engine(spark, label="DECLINE", quality=0.7)["refer_reasons"] == []


def test_platt_is_monotone_and_anomaly_is_inverted(column):
    p = column(lambda c: decision.platt(c, 3.0, -1.0), [0.0, 0.5, 1.0])
    assert p == sorted(p) and all(0 < x < 1 for x in p)
    assert column(lambda c: decision.anomaly_score(c, F.lit(-0.6), F.lit(-0.4)), [-0.6, -0.5, -0.4, -0.9]) == pytest.approx([1, .5, 0, 1])
    assert column(lambda c: decision.anomaly_score(c, F.lit(-0.4), F.lit(-0.4)), [-0.4]) == [0.5]


def test_age_group_is_nearest_within_tolerance(column):
    assert column(monitoring.age_group, [0.0, 0.65, 0.67, 0.68, 0.7, 0.9, 1.0, 0.5, None]) == [
        "INELIGIBLE", "SENIOR", "SENIOR", "YOUNG", "YOUNG", "MATURE", "PRIME", "UNKNOWN", "UNKNOWN"]


def test_histogram_edges_follow_doubles(column):
    assert column(monitoring.histogram_bin, [0.0, 0.1, 0.3, 0.30000000000000004, 0.7, 1.0, -0.1, 1.1]) == [0, 1, 2, 3, 6, 9, None, None]


def _scored(spark, **options):
    row = {f: 1.0 for f in catalog.FEATURES}
    row.update(has_judgement=0.0, has_written_off=0.0, has_charged_off=0.0, has_legal_handover=0.0, has_adverse_default=0.0, num_bounced_cheques=0.35)
    names = [*row, "applicant_age_years", "bounced_cheques", "hit_status", "delinquency"]
    df = spark.createDataFrame([(*row.values(), 40, 2, "HIT", 4.0)], ", ".join(
        f"{n} {'string' if n == 'hit_status' else 'int' if n in ('applicant_age_years', 'bounced_cheques') else 'double'}" for n in names))
    return features.score(df, **options).first()


def test_polarity_switches(spark):
    kept, fixed = _scored(spark), _scored(spark, fix_polarity=True)
    assert kept["credit_score"] - fixed["credit_score"] == 8  # 50/550 of a group that weighs 0.15
    assert kept["hard_stop_code"] is None and _scored(spark, raw_delinquency_stop=True)["hard_stop_code"] == "DELINQUENCY_CRITICAL"
