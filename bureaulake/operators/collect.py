"""Prediction results of many requests to one row per request, and the two-phase gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions.bins import case

RESULT_FIELDS = {
    "credit_risk": ["probability_of_default"],
    "fraud_detection": ["fraud_anomaly_score", "fraud_risk_flag"],
    "loan_amount": ["recommended_loan_amount"],
    "income_verification": ["income_tier", "income_confidence"],
}
ALL_FIELDS = [f for fields in RESULT_FIELDS.values() for f in fields]


def pivot_results(results: DataFrame) -> DataFrame:
    """Long result rows (request_id, model_type, seq, fields) to one row per request.

    The newest delivery per model wins; one shuffle on request_id with bounded state replaces four joins.
    """
    def newest(model):
        fields = F.struct("seq", *RESULT_FIELDS[model])
        return F.max(F.when(F.col("model_type") == model, fields)).alias(f"r_{model}")

    wide = results.groupBy("request_id").agg(*[newest(m) for m in catalog.MODELS])
    present = F.array_compact(F.array(*[F.when(F.col(f"r_{m}").isNotNull(), F.lit(m)) for m in catalog.MODELS]))
    fields = [F.col(f"r_{m}")[f].alias(f) for m in catalog.MODELS for f in RESULT_FIELDS[m]]
    return wide.select("request_id", present.alias("present"), *fields)


def skip_phase_two(fraud_flag: Column, label: Column) -> Column:
    return F.coalesce(fraud_flag == "HIGH", F.lit(False)) | F.coalesce(label.isin("DECLINE", "REFER"), F.lit(False))


def collect(contexts: DataFrame, wide: DataFrame) -> DataFrame:
    """Contexts (request_id, models, selective, decision_label) with results, state and defaults.

    ``state``: decide, trigger_phase_2 or waiting.
    """
    nothing = F.array().cast("array<string>")
    joined = contexts.join(wide, "request_id", "left").withColumn("present", F.coalesce("present", nothing))
    has = {m: F.array_contains("present", m) for m in catalog.MODELS}
    missing = F.array_except("models", "present")
    phase_1 = has["credit_risk"] & has["fraud_detection"]
    phase_2 = has["loan_amount"] & has["income_verification"]
    skip = skip_phase_two(F.col("fraud_risk_flag"), F.col("decision_label"))
    state = case([
        (F.col("selective") & (F.size(missing) > 0), "waiting"), (F.col("selective"), "decide"),
        (~phase_1, "waiting"), (skip | phase_2, "decide")], "trigger_phase_2")
    use_later = F.col("selective") | ~skip
    return joined.withColumns({
        "state": state,
        "probability_of_default": F.coalesce("probability_of_default", F.lit(0.5)),
        "fraud_risk_flag": F.coalesce("fraud_risk_flag", F.lit("LOW")),
        "fraud_anomaly_score": F.coalesce("fraud_anomaly_score", F.lit(0.0)),
        "recommended_loan_amount": F.when(use_later, F.col("recommended_loan_amount")),
        "income_tier": F.when(use_later, F.col("income_tier")),
        "income_confidence": F.when(use_later, F.col("income_confidence")),
    })
