"""Drift and fairness over feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions.bins import case

#: Fixed value: rows that a window needs before drift is judged from it.
LEAST_ROWS = 50


def histogram_bin(value: Column) -> Column:
    """0..9 by the ten equal edges of [0, 1] as doubles, the last bin closed; null outside."""
    step = 1.0 / catalog.DRIFT_BINS
    inside = case([(value >= i * step, i) for i in range(catalog.DRIFT_BINS - 1, 0, -1)], 0)
    return F.when((value >= 0.0) & (value <= 1.0), inside)


def histograms(vectors: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``feature, bin, n`` per group in ``keep``; a null ``bin`` counts values outside [0, 1].

    Rows are unpivoted and counted map-side, so the shuffle carries at most 11 rows per feature and task.
    """
    long = vectors.unpivot(list(keep), catalog.FEATURES, "feature", "value").filter("value is not null")
    return long.groupBy(*keep, "feature", histogram_bin(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def psi(baseline: DataFrame, recent: DataFrame, minimum: int = 10) -> DataFrame:
    """PSI per feature from two histograms; features with fewer recent values than ``minimum`` are left out.

    Both inputs are at most 330 rows.  Baseline shares use the counts in its bins, recent shares all values.
    """
    def totals(h, name, inside_only):
        rows = h.filter("bin is not null") if inside_only else h
        return rows.groupBy("feature").agg(F.sum("n").alias(name))

    e_total, a_total = totals(baseline, "e_total", True), totals(recent, "a_total", False)
    both = e_total.join(a_total, "feature").filter(F.col("a_total") >= minimum)
    bins = F.explode(F.sequence(F.lit(0), F.lit(catalog.DRIFT_BINS - 1)))
    grid = (both.select("*", bins.alias("bin"))
            .join(baseline.select("feature", "bin", F.col("n").alias("e_n")), ["feature", "bin"], "left")
            .join(recent.select("feature", "bin", F.col("n").alias("a_n")), ["feature", "bin"], "left"))
    expected = F.coalesce("e_n", F.lit(0)) / F.col("e_total") + catalog.PSI_EPSILON
    actual = F.coalesce("a_n", F.lit(0)) / F.col("a_total") + catalog.PSI_EPSILON
    return grid.groupBy("feature").agg(F.sum((actual - expected) * F.log(actual / expected)).alias("raw_psi")).select(
        "feature", "raw_psi", F.round("raw_psi", 4).alias("psi"), severity(F.col("feature"), F.col("raw_psi")).alias("severity"))


def cohort_psi(histograms: DataFrame, baseline: str, recent: str, minimum: int = 10) -> DataFrame:
    """The same from one table of ``cohort, feature, bin, n``: one aggregation, so the facts behind it are read once."""
    def count(cohort, *condition):
        wanted = F.col("cohort") == cohort
        for c in condition:
            wanted = wanted & c
        return F.sum(F.when(wanted, F.col("n")))

    bins = range(catalog.DRIFT_BINS)
    wide = histograms.groupBy("feature").agg(
        count(baseline, F.col("bin").isNotNull()).alias("e_total"), count(recent).alias("a_total"),
        *[count(baseline, F.col("bin") == i).alias(f"e{i}") for i in bins], *[count(recent, F.col("bin") == i).alias(f"a{i}") for i in bins])
    raw = F.lit(0.0)
    for i in bins:
        expected = F.coalesce(f"e{i}", F.lit(0)) / F.col("e_total") + catalog.PSI_EPSILON
        actual = F.coalesce(f"a{i}", F.lit(0)) / F.col("a_total") + catalog.PSI_EPSILON
        raw = raw + (actual - expected) * F.log(actual / expected)
    scored = wide.filter((F.col("e_total") > 0) & (F.col("a_total") >= minimum)).select("feature", raw.alias("raw_psi"))
    return scored.select("feature", "raw_psi", F.round("raw_psi", 4).alias("psi"), severity(F.col("feature"), F.col("raw_psi")).alias("severity"))


def severity(feature: Column, value: Column) -> Column:
    group_a = feature.isin(catalog.FEATURE_GROUPS["A"])
    return case([
        ((value >= catalog.PSI_SIGNIFICANT) & group_a, "HIGH"), (value >= catalog.PSI_SIGNIFICANT, "MEDIUM"),
        (value >= catalog.PSI_MINOR, "MINOR")], "NONE")


def verdict(scores: DataFrame) -> DataFrame:
    """One row: drifted counts, whether payment history drifted, recommendation, models to retrain."""
    drifted = F.col("severity").isin("HIGH", "MEDIUM")

    def hit(*features):
        return F.coalesce(F.bool_or(drifted & F.col("feature").isin(*features)), F.lit(False))

    counted = scores.agg(
        F.count_if(drifted).alias("drifted"), F.count_if(F.col("severity") == "MINOR").alias("minor"),
        F.coalesce(F.bool_or(F.col("severity") == "HIGH"), F.lit(False)).alias("has_group_a_drift"),
        hit("total_outstanding_debt_ghs", "utilisation_ratio", "total_monthly_instalment_ghs").alias("loan"),
        hit("has_employer_detail", "total_monthly_instalment_ghs", "credit_age_months").alias("income"))
    models = F.array_compact(F.array(
        F.lit("credit_risk"), F.when(F.col("loan"), F.lit("loan_amount")),
        F.when(F.col("income"), F.lit("income_verification")), F.lit("fraud_detection")))
    return counted.select(
        "drifted", "minor", "has_group_a_drift",
        F.when(F.col("has_group_a_drift") | (F.col("drifted") >= 3), F.lit("retrain")).otherwise("monitor").alias("recommendation"),
        models.alias("models_to_retrain"))


def age_group(weight: Column) -> Column:
    """Nearest age-bin weight closer than 0.05, else UNKNOWN.

    Only the centres 0.65 and 0.70 are near enough to each other to compete; they part at 0.675.
    """
    def near(centre):
        return F.abs(weight - centre) < 0.05

    near_by = {centre: near(centre) for centre in catalog.AGE_GROUPS}
    near_by[0.70] = near(0.70) & (weight >= 0.675)
    return case([(near_by[centre], name) for centre, name in catalog.AGE_GROUPS.items()], "UNKNOWN")


def group_table(df: DataFrame) -> DataFrame:
    """One row per age group from ``age_group, actual, predicted``: all that both checks need.

    Groups that are not shown are marked, not filtered: a filter on the group would be pushed down to the rows
    and repeat the whole derivation of the group there.
    """
    positive = F.col("actual") == 1
    return df.groupBy("age_group").agg(
        F.count(F.lit(1)).alias("n"), F.avg("predicted").alias("positive_rate"), F.count_if(positive).alias("positives"),
        F.count_if(positive & (F.col("predicted") == 0)).alias("missed"),
    ).withColumns({
        "shown": ~F.col("age_group").isin("INELIGIBLE", "UNKNOWN"),
        "fnr": F.round(F.col("missed") / F.when(F.col("positives") > 0, F.col("positives")), 4)})


def disparate_impact(groups: DataFrame, minimum: int = 10) -> DataFrame:
    """Lowest over highest positive rate among groups with enough rows; takes :func:`group_table`."""
    rate = F.when(F.col("shown") & (F.col("n") >= minimum), F.col("positive_rate"))
    spread = groups.agg(F.count(rate).alias("groups"), F.min(rate).alias("low"), F.max(rate).alias("high"))
    ratio = F.when((F.col("groups") < 2) | (F.col("high") <= 0), F.lit(1.0)).otherwise(
        F.col("low") / F.when(F.col("high") > 0, F.col("high")))
    return spread.select("groups", F.round(ratio, 4).alias("di_ratio"), (ratio < catalog.IMPACT_RATIO_MIN).alias("di_violation"))


def equal_opportunity(groups: DataFrame, minimum: int = 5) -> DataFrame:
    """Widest gap of false-negative rates among groups with enough positives; takes :func:`group_table`."""
    rate = F.when(F.col("shown") & (F.col("positives") >= minimum), F.col("fnr"))
    spread = groups.agg(F.count(rate).alias("groups"), (F.max(rate) - F.min(rate)).alias("gap"))
    gap = F.when(F.col("groups") < 2, F.lit(0.0)).otherwise(F.col("gap"))
    return spread.select("groups", F.round(gap, 4).alias("max_gap"), (gap > catalog.FNR_GAP_MAX).alias("eo_violation"))


def fairness_report(groups: DataFrame) -> DataFrame:
    """Both checks in one row."""
    impact, chance = disparate_impact(groups).drop("groups"), equal_opportunity(groups).drop("groups")
    return impact.crossJoin(F.broadcast(chance)).select(  # one row each
        "*", (F.col("di_violation").cast("int") + F.col("eo_violation").cast("int")).alias("violations"),
        (~F.col("di_violation") & ~F.col("eo_violation")).alias("passed"))
