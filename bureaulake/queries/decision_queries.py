"""Queries: imputation, decision engine, collection of predictions, audit, lookups, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.catalog import AsOf
from bureaulake.functions import decision as dec
from bureaulake.functions import parse
from bureaulake.functions.bins import case
from bureaulake.operators import batches, collect, features, imputation, ranking, registry
from bureaulake.plans import facts
from bureaulake.queries.ctes import FEATURE_NAMES, sql
from bureaulake.queries.scoring_queries import _INCOME, _FLAG, _missing_count, _REQUIRED_SQL, training_rows
from bureaulake.sources import scratch, views
from bureaulake.sources.views import table

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


# --- imputation --------------------------------------------------------------------------------------------

_MED = ["months_on_time_24m", "current_streak_on_time", "address_stability"]
_ZERO = ["worst_arrears_24m", "product_diversity_score", "has_judgement", "num_bounced_cheques", "has_adverse_default",
         "mobile_loan_history_count", "mobile_max_loan_ghs"]
_PARAMS = " UNION ALL ".join(
    [f"SELECT '{n}' AS feature, 'MEDIAN' AS strategy, coalesce(median({n}), 0e0) AS value FROM raw_feature" for n in _MED]
    + [f"SELECT '{n}', 'ZERO', 0e0" for n in _ZERO])


def _raw(spark, d):
    return facts.feature_table(spark, d, impute=False)


@query("imputation_params", sql("SELECT feature, strategy, value FROM params", params=_PARAMS))
def imputation_params(spark, d):
    return imputation.parameter_rows(imputation.parameters(_raw(spark, d)))


@query("impute_training", sql("SELECT request_id, " + ", ".join(
    [f"coalesce({n}, (SELECT coalesce(median({n}), 0e0) FROM raw_feature)) AS {n}" for n in _MED]
    + [f"coalesce({n}, 0e0) AS {n}" for n in _ZERO]) + " FROM raw_feature"))
def impute_training(spark, d):
    vectors = _raw(spark, d)
    return imputation.impute(vectors, imputation.parameters(vectors)).select("request_id", *_MED, *_ZERO)


@query("impute_inference", sql(f"""SELECT request_id, months_on_time_24m, mobile_max_loan_ghs,
  CASE WHEN ({_missing_count(_REQUIRED_SQL)}) > 0 THEN 'no imputation rule for: ' || concat_ws(',', {', '.join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in _REQUIRED_SQL)}) END AS error
FROM (SELECT * REPLACE (coalesce(months_on_time_24m, 0.55e0) AS months_on_time_24m, coalesce(mobile_max_loan_ghs, 0e0) AS mobile_max_loan_ghs) FROM raw_feature)"""))
def impute_inference(spark, d):
    """Live vectors filled from stored parameters; a gap without a rule is reported, not dropped."""
    stored = spark.createDataFrame([tuple(float(catalog.POLICY_VALUES[f]) for f in catalog.IMPUTABLE)],
                                   ", ".join(f"{f} double" for f in catalog.IMPUTABLE))
    filled = imputation.impute(_raw(spark, d), stored)
    return filled.select("request_id", "months_on_time_24m", "mobile_max_loan_ghs", imputation.unfilled().alias("error"))


_POLICY = " UNION ALL ".join(f"SELECT '{n}' AS feature, '{'MEDIAN' if n in _MED else 'ZERO'}' AS strategy, {v}e0 AS value" for n, v in [
    ("months_on_time_24m", 0.55), ("worst_arrears_24m", 0.0), ("current_streak_on_time", 0.45), ("product_diversity_score", 0.0),
    ("has_judgement", 0.0), ("num_bounced_cheques", 0.0), ("has_adverse_default", 0.0), ("address_stability", 0.75),
    ("mobile_loan_history_count", 0.0), ("mobile_max_loan_ghs", 0.0)])
_LIVE = """SELECT p.feature, o.value AS old_value, round(p.value, 6) AS candidate_value, round(abs(p.value - o.value), 6) AS drift_abs,
  abs(p.value - o.value) >= 0.05e0 AS updated, CASE WHEN abs(p.value - o.value) >= 0.05e0 THEN round(p.value, 6) ELSE o.value END AS value
FROM params p JOIN policy o USING (feature) WHERE p.strategy = 'MEDIAN'"""


def _static_policy(spark):
    return spark.createDataFrame(
        [(f, s, float(catalog.POLICY_VALUES[f])) for f, s in catalog.IMPUTABLE.items()], "feature string, strategy string, value double")


@query("live_contract", sql("SELECT * FROM live", live=_LIVE, params=_PARAMS, policy=_POLICY))
def live_contract(spark, d):
    return imputation.live_contract(imputation_params(spark, d), _static_policy(spark))


@query("effective_policy", sql("""SELECT p.feature, p.strategy, coalesce(l.value, p.value) AS value,
  CASE WHEN l.value IS NULL THEN 'static' ELSE 'live' END AS source FROM policy p LEFT JOIN live l USING (feature)""",
                             live=_LIVE, params=_PARAMS, policy=_POLICY))
def effective_policy(spark, d):
    return imputation.effective_policy(_static_policy(spark), live_contract(spark, d))


@query("params_json", sql("SELECT feature, value FROM params", params=_PARAMS))
def params_json(spark, d):
    """Parameters as one JSON text and back."""
    one = imputation.parameters(_raw(spark, d))
    names = list(catalog.IMPUTABLE)
    text = one.select(F.to_json(F.struct(*names)).alias("json"))
    back = text.select(F.from_json("json", "map<string,double>").alias("m"))
    return back.select(F.explode("m").alias("feature", "value"))


@query("validate_training", sql("""SELECT 'Missing feature columns: [''num_enquiries_3m'']' AS error
UNION ALL SELECT 'Missing target columns: [''income_tier'']' UNION ALL SELECT 'Feature ''applicant_age'' is not numeric'
UNION ALL SELECT 'Dataset is empty (0 records)' FROM (SELECT count(*) AS n FROM customer) WHERE n = 0"""))
def validate_training(spark, d):
    """A broken copy of the whole training table: two columns gone, one of text type."""
    rows = training_rows(spark, d)
    broken = rows.drop("num_enquiries_3m", "income_tier").withColumn("applicant_age", F.col("applicant_age").cast("string"))
    return imputation.training_report(broken)


@query("contract_features", sql(f"""SELECT hit_status, count(*) AS n, count(*) FILTER (({_missing_count(FEATURE_NAMES)}) = 0) AS complete,
  count(*) FILTER ({' AND '.join(f'coalesce({n}, 0) BETWEEN 0 AND 1' for n in FEATURE_NAMES)}) AS in_range FROM feature GROUP BY 1"""))
def contract_features(spark, d):
    """Exactly the thirty features, all in [0, 1]."""
    vectors = facts.feature_table(spark, d)
    absent = [f for f in catalog.FEATURES if f not in vectors.columns]
    if absent:
        raise ValueError(f"feature contract violated, missing: {absent}")
    in_range = F.forall(F.array(*catalog.FEATURES), lambda v: F.coalesce(v.between(0, 1), F.lit(True)))
    return vectors.groupBy("hit_status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size(features.missing_features()) == 0).alias("complete"),
        F.count_if(in_range).alias("in_range"))


# --- gold tables ---------------------------------------------------------------------------------------------

_SOURCE = "'core' AS source_system, 'bank-' || (applicant_id % 3) AS data_source_id"
_META = ["product_source", "product_mix", "credit_score", "score_grade", "decision", "feature_coverage_ratio"]


def _gold_rows(spark, d):
    key = F.col("applicant_id")
    return training_rows(spark, d).withColumns({
        "row_id": F.sha2("request_id", 256), "source_system": F.lit("core"),
        "data_source_id": F.concat(F.lit("bank-"), key % 3),
        "missing_json": F.to_json("missing_features"), "reasons_json": F.to_json("decision_reason_codes")})


def _written(df, path, *partitions):
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.parquet(path)


@query("gold_features", sql(f"""SELECT sha256(request_id) AS row_id, {', '.join(FEATURE_NAMES)}, {_FLAG} AS default_flag,
  max_repaid AS max_successful_loan_ghs, {_SOURCE} FROM feature"""))
def gold_features(spark, d):
    rows = _gold_rows(spark, d).select("row_id", *catalog.FEATURES, "default_flag", "max_successful_loan_ghs", "source_system", "data_source_id")
    return _written(rows, scratch.folder(spark, "gold-features"), "source_system", "data_source_id")


@query("gold_metadata", sql(f"""SELECT sha256(request_id) AS row_id, request_id, hit_status, credit_score, score_grade, decision,
  '[' || CASE WHEN decision_reason_codes = '' THEN '' ELSE '"' || replace(decision_reason_codes, ',', '","') || '"' END || ']' AS reasons_json,
  {_SOURCE} FROM scored"""))
def gold_metadata(spark, d):
    rows = _gold_rows(spark, d).select("row_id", "request_id", "hit_status", "credit_score", "score_grade", "decision",
                                       "reasons_json", "source_system", "data_source_id")
    return _written(rows, scratch.folder(spark, "gold-metadata"), "source_system", "data_source_id")


@query("gold_flat", sql(f"""SELECT request_id, hit_status, {', '.join(FEATURE_NAMES[:6])}, {_FLAG} AS default_flag, decision, {_SOURCE}
FROM scored"""))
def gold_flat(spark, d):
    rows = _gold_rows(spark, d).select("request_id", "hit_status", *catalog.FEATURES[:6], "default_flag", "decision",
                                       "source_system", "data_source_id")
    return _written(rows, scratch.folder(spark, "gold-flat"), "source_system", "data_source_id")


# --- decision engine -------------------------------------------------------------------------------------------


@query("risk_tiers", sql("""SELECT request_id, CASE WHEN pd > 1 THEN NULL WHEN pd < 0.05e0 THEN 'VERY_LOW' WHEN pd < 0.1e0 THEN 'LOW'
  WHEN pd < 0.15e0 THEN 'LOW_MEDIUM' WHEN pd < 0.2e0 THEN 'MEDIUM' WHEN pd < 0.4e0 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_tier,
  pd > 1 AS out_of_range, CASE WHEN amount < 5000 THEN 'MICRO' WHEN amount < 25000 THEN 'SMALL' WHEN amount < 100000 THEN 'MEDIUM'
  WHEN amount < 250000 THEN 'LARGE' ELSE 'PREMIUM' END AS loan_tier, least(greatest(amount, 500e0), 10000e0) AS clamped
FROM (SELECT *, probability_of_default * 1.1e0 AS pd, recommended_loan_amount * 25 - 12600 AS amount FROM prediction)"""))
def risk_tiers(spark, d):
    p = views.predictions(spark, d)
    probability = F.col("probability_of_default") * 1.1
    amount = F.col("recommended_loan_amount") * 25 - 12600
    return p.select("request_id", dec.pd_tier(probability).alias("risk_tier"),
                    dec.pd_tier(probability).isNull().alias("out_of_range"),
                    dec.loan_tier(amount).alias("loan_tier"), dec.clamp_loan(amount).alias("clamped"))


@query("grade_policy", sql("""SELECT score_grade, CASE score_grade WHEN 'D' THEN 'CONDITIONAL_APPROVE' WHEN 'E' THEN 'REFER' WHEN 'F' THEN 'DECLINE' ELSE 'APPROVE' END AS base_decision,
  CASE score_grade WHEN 'A' THEN 'PREMIUM' WHEN 'B' THEN 'LARGE' WHEN 'C' THEN 'MEDIUM' WHEN 'D' THEN 'SMALL' WHEN 'E' THEN 'MICRO' END AS max_loan_tier, count(*) AS n
FROM scored GROUP BY 1, 2, 3"""))
def grade_policy(spark, d):
    grade = F.col("score_grade")
    return facts.decisions(spark, d).groupBy(
        "score_grade", dec.grade_decision(grade).alias("base_decision"), dec.grade_loan_tier(grade).alias("max_loan_tier")
    ).agg(F.count(F.lit(1)).alias("n"))


# Decision labels by key, one of them unknown.
_LABELS = ["APPROVE", "CONDITIONAL_APPROVE", "REFER", "DECLINE", "FRAUD_HOLD", "MAYBE"]
_LABEL_SQL = "(['APPROVE','CONDITIONAL_APPROVE','REFER','DECLINE','FRAUD_HOLD','MAYBE'])[{} + 1]"
_RANK_SQL = "CASE {} WHEN 'FRAUD_HOLD' THEN 0 WHEN 'DECLINE' THEN 1 WHEN 'REFER' THEN 2 WHEN 'CONDITIONAL_APPROVE' THEN 3 WHEN 'APPROVE' THEN 4 END"


def _label(index):
    return F.element_at(F.array(*[F.lit(x) for x in _LABELS]), (index + 1).cast("int"))


@query("decision_conflict", sql(f"""SELECT c_custkey AS key, derived, given, CASE WHEN {_RANK_SQL.format('given')} < {_RANK_SQL.format('derived')}
  THEN given ELSE derived END AS resolved FROM (SELECT c_custkey, {_LABEL_SQL.format('c_custkey % 5')} AS derived, {_LABEL_SQL.format('(c_custkey // 5) % 6')} AS given FROM customer)"""))
def decision_conflict(spark, d):
    key = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        key.alias("key"), _label(key % 5).alias("derived"), _label(F.floor(key / 5) % 6).alias("given"))
    return rows.withColumn("resolved", dec.more_conservative(F.col("derived"), F.col("given")))


def _engine_input(spark, d):
    """Scored applicants with model results and a quality score."""
    scored = facts.decisions(spark, d)
    p = views.predictions(spark, d).drop("request_id")
    return scored.join(p, "applicant_id").withColumns({
        "data_quality_score": F.lit(0.5) + (F.col("applicant_id") * 3 % 50) / 100.0,
        "fraud_risk_flag": case([(F.col("anomaly_raw") < -0.68, "HIGH"), (F.col("anomaly_raw") < -0.6, "MEDIUM")], "LOW")})


_ENGINE = """SELECT s.* EXCLUDE (reasons), p.probability_of_default, p.anomaly_raw, p.recommended_loan_amount, p.income_tier, p.income_confidence,
  0.5e0 + (applicant_id * 3 % 50) / 100e0 AS quality, CASE WHEN anomaly_raw < -0.68e0 THEN 'HIGH' WHEN anomaly_raw < -0.6e0 THEN 'MEDIUM' ELSE 'LOW' END AS fraud_flag
FROM scored s JOIN prediction p USING (applicant_id)"""
_SOFT = """concat_ws('|', CASE WHEN coalesce(num_enquiries_3m, 1e0) <= 0.05e0 THEN 'Excessive bureau enquiries in last 3 months (credit shopping)' END,
  CASE WHEN credit_score BETWEEN 450 AND 519 THEN 'Borderline credit score (450-519) — requires analyst review' END,
  CASE WHEN income_confidence < 0.65e0 THEN 'Income verification confidence below 0.65' END,
  CASE WHEN quality BETWEEN 0.6e0 AND 0.75e0 THEN 'Data quality score marginal (' || format('{:.2f}', quality) || ')' END)"""
_CEILING = "CASE score_grade WHEN 'B' THEN 250000 WHEN 'C' THEN 100000 WHEN 'D' THEN 25000 WHEN 'E' THEN 5000 END"


def _conditions_sql(amount):
    return f"""concat_ws('|', CASE WHEN {amount} > {_CEILING} THEN 'CA-01: Loan amount capped at GHS ' || format('{{:,.2f}}', CAST({_CEILING} AS DOUBLE)) END,
  CASE WHEN coalesce(applicant_age_years, 0) > 65 THEN 'CA-02: Maximum tenor reduced due to applicant age (' || applicant_age_years || ')'
    WHEN total_monthly_instalment_ghs > 0.7e0 THEN 'CA-02: Maximum tenor reduced due to elevated debt-service ratio' END,
  CASE WHEN credit_score BETWEEN 520 AND 560 AND coalesce(num_closed_accounts_good, 0e0) < 0.15e0 THEN 'CA-03: Guarantor required'
    WHEN has_active_arrears > 0.5e0 THEN 'CA-03: Guarantor required due to active arrears' END,
  CASE WHEN {amount} > 100000 AND credit_score < 700 THEN 'CA-04: Collateral documentation required' END,
  CASE WHEN income_confidence < 0.65e0 AND credit_score >= 600 THEN 'CA-05: Income verification documents required within 5 business days'
    WHEN coalesce(has_employer_detail, 0e0) < 0.5e0 THEN 'CA-05: Income verification documents required — no employer details on file' END,
  CASE WHEN num_active_accounts > 0.6e0 AND utilisation_ratio > 0.7e0 THEN 'CA-06: First draw limited to 50% of approved amount' END)"""


_C = features.feature_columns


@query("soft_stops", sql(f"SELECT request_id, {_SOFT} AS reasons FROM engine", engine=_ENGINE))
def soft_stops(spark, d):
    rows = _engine_input(spark, d)
    reasons = dec.soft_stops(_C(), F.col("credit_score"), F.col("income_confidence"), F.col("data_quality_score"))
    return rows.select("request_id", F.array_join(reasons, "|").alias("reasons"))


@query("approval_conditions", sql(f"SELECT request_id, {_conditions_sql('(recommended_loan_amount * 20)')} AS conditions FROM engine", engine=_ENGINE))
def approval_conditions(spark, d):
    rows = _engine_input(spark, d)
    found = dec.conditions(_C(), F.col("credit_score"), F.col("applicant_age_years"), F.col("income_confidence"),
                           F.col("recommended_loan_amount") * 20, F.col("score_grade"))
    return rows.select("request_id", F.array_join(found, "|").alias("conditions"))


_BASE = "CASE score_grade WHEN 'D' THEN 'CONDITIONAL_APPROVE' WHEN 'E' THEN 'REFER' WHEN 'F' THEN 'DECLINE' ELSE 'APPROVE' END"
_FINAL = f"""SELECT *, CASE WHEN fraud_flag = 'HIGH' THEN 'FRAUD_HOLD' WHEN reasons <> '' THEN 'REFER' ELSE resolved END AS final
FROM (SELECT *, CASE WHEN fraud_flag <> 'HIGH' AND resolved IN ('APPROVE', 'CONDITIONAL_APPROVE') THEN {_SOFT} ELSE '' END AS reasons
  FROM (SELECT *, CASE WHEN {_RANK_SQL.format('decision')} < {_RANK_SQL.format(_BASE)} THEN decision ELSE {_BASE} END AS resolved FROM engine))"""
_PD_TIER = """CASE WHEN probability_of_default < 0.05e0 THEN 'VERY_LOW' WHEN probability_of_default < 0.1e0 THEN 'LOW' WHEN probability_of_default < 0.15e0 THEN 'LOW_MEDIUM'
  WHEN probability_of_default < 0.2e0 THEN 'MEDIUM' WHEN probability_of_default < 0.4e0 THEN 'HIGH' ELSE 'VERY_HIGH' END"""


def _decided(rows):
    found = dec.final_decision(
        F.col("probability_of_default"), F.col("score_grade"), F.col("decision"), F.col("fraud_risk_flag"), _C(),
        F.col("recommended_loan_amount"), F.col("credit_score"), F.col("applicant_age_years"),
        F.col("income_confidence"), F.col("data_quality_score"))
    return {f"final_{n}": c for n, c in found.items()}


@query("final_decision", sql(f"""SELECT request_id, final AS final_decision, {_PD_TIER} AS final_risk_tier,
  CASE score_grade WHEN 'A' THEN 'PREMIUM' WHEN 'B' THEN 'LARGE' WHEN 'C' THEN 'MEDIUM' WHEN 'D' THEN 'SMALL' WHEN 'E' THEN 'MICRO' END AS final_recommended_loan_tier,
  reasons AS final_refer_reasons, CASE WHEN final = 'CONDITIONAL_APPROVE' THEN {_conditions_sql('recommended_loan_amount')} ELSE '' END AS final_conditions
FROM final""", engine=_ENGINE, final=_FINAL))
def final_decision(spark, d):
    rows = _engine_input(spark, d)
    joined = {"final_refer_reasons", "final_conditions"}
    return rows.select("request_id", *[
        (F.array_join(c, "|") if n in joined else c).alias(n) for n, c in _decided(rows).items()])


@query("rules_whatif", sql(f"""SELECT key, CASE WHEN pd > 1 THEN 'probability_of_default must be between 0 and 1' WHEN score_grade = 'G' THEN 'invalid score grade: G'
    WHEN fraud_flag = 'SEVERE' THEN 'invalid fraud_risk_flag: SEVERE' END AS error,
  CASE WHEN pd <= 1 AND score_grade <> 'G' AND fraud_flag <> 'SEVERE' THEN final END AS decision,
  CASE WHEN pd <= 1 AND score_grade <> 'G' AND fraud_flag <> 'SEVERE' AND final = 'CONDITIONAL_APPROVE' THEN {_conditions_sql('amount')} ELSE '' END AS conditions
FROM (SELECT *, CASE WHEN fraud_flag = 'HIGH' THEN 'FRAUD_HOLD' WHEN resolved IN ('APPROVE', 'CONDITIONAL_APPROVE') AND {_SOFT} <> '' THEN 'REFER' ELSE resolved END AS final
  FROM (SELECT *, CASE WHEN {_RANK_SQL.format('given')} < {_RANK_SQL.format(_BASE)} THEN given ELSE {_BASE} END AS resolved FROM scenario))""",
                         scenario="""SELECT c_custkey AS key, (c_custkey * 37 % 1100) / 1000e0 AS pd, (['A','B','C','D','E','F','G'])[c_custkey % 7 + 1] AS score_grade,
  coalesce((['APPROVE','CONDITIONAL_APPROVE','REFER','DECLINE','FRAUD_HOLD','MAYBE'])[c_custkey % 9 + 1], 'APPROVE') AS given,
  (['LOW','MEDIUM','HIGH','SEVERE','LOW'])[c_custkey % 5 + 1] AS fraud_flag, (c_custkey * 997 % 300000) + 0e0 AS amount,
  CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 11) / 10e0 ELSE 0.5e0 END AS total_monthly_instalment_ghs,
  CASE WHEN c_custkey % 4 = 0 THEN 0.9e0 ELSE 0.5e0 END AS num_active_accounts, CASE WHEN c_custkey % 8 = 0 THEN 0.8e0 ELSE 0.5e0 END AS utilisation_ratio,
  CASE WHEN c_custkey % 6 = 1 THEN 0.05e0 ELSE 0.5e0 END AS num_enquiries_3m, 0.5e0 AS num_closed_accounts_good, 0.5e0 AS has_active_arrears, 0.5e0 AS has_employer_detail,
  CAST(300 + c_custkey % 550 AS INTEGER) AS credit_score, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 100) / 100e0 END AS income_confidence,
  CAST(c_custkey % 90 AS INTEGER) AS applicant_age_years, CASE WHEN c_custkey % 5 = 0 THEN 0.7e0 ELSE 1e0 END AS quality FROM customer"""))
def rules_whatif(spark, d):
    """Decision engine over a table of scenarios; a bad scenario gets an error instead of a decision."""
    key = F.col("c_custkey")
    sent = F.map_from_entries(F.array_compact(F.array(
        F.when(key % 3 == 0, F.struct(F.lit("total_monthly_instalment_ghs").alias("k"), (key % 11 / 10.0).alias("v"))),
        F.when(key % 4 == 0, F.struct(F.lit("num_active_accounts").alias("k"), F.lit(0.9).alias("v"))),
        F.when(key % 8 == 0, F.struct(F.lit("utilisation_ratio").alias("k"), F.lit(0.8).alias("v"))),
        F.when(key % 6 == 1, F.struct(F.lit("num_enquiries_3m").alias("k"), F.lit(0.05).alias("v"))))))
    grades = F.array(*[F.lit(g) for g in "ABCDEFG"])
    flags = F.array(*[F.lit(f) for f in ("LOW", "MEDIUM", "HIGH", "SEVERE", "LOW")])
    rows = table(spark, d, "customer").select(
        key.alias("key"), (key * 37 % 1100 / 1000.0).alias("pd"), F.get(grades, (key % 7).cast("int")).alias("grade"),
        F.coalesce(F.get(F.array(*[F.lit(x) for x in _LABELS]), (key % 9).cast("int")), F.lit("APPROVE")).alias("given"),
        F.get(flags, (key % 5).cast("int")).alias("flag"), (key * 997 % 300000).cast("double").alias("amount"), sent.alias("features"),
        (key % 550 + 300).cast("int").alias("score"), F.when(key % 2 == 0, key % 100 / 100.0).alias("confidence"),
        (key % 90).cast("int").alias("age"), F.when(key % 5 == 0, F.lit(0.7)).alias("quality"))
    error = case([
        (~F.col("pd").between(0, 1), F.lit("probability_of_default must be between 0 and 1")),
        (~F.col("grade").isin(catalog.GRADES), F.concat(F.lit("invalid score grade: "), "grade")),
        (~F.col("flag").isin("LOW", "MEDIUM", "HIGH"), F.concat(F.lit("invalid fraud_risk_flag: "), "flag"))])
    filled = {f: F.coalesce(F.col("features")[f], F.lit(0.5)) for f in catalog.FEATURES}
    found = dec.final_decision(F.col("pd"), F.col("grade"), F.col("given"), F.col("flag"), filled, F.col("amount"),
                               F.col("score"), F.col("age"), F.col("confidence"), F.col("quality"))
    ok = F.col("error").isNull()
    return rows.withColumn("error", error).select(
        "key", "error", F.when(ok, found["decision"]).alias("decision"),
        F.when(ok, F.array_join(found["conditions"], "|")).otherwise("").alias("conditions"))


# --- collecting predictions --------------------------------------------------------------------------------------


def results(spark, d):
    """Long result rows by formula: some late, some delivered twice."""
    p, key = views.predictions(spark, d), F.col("applicant_id")
    model = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(catalog.MODELS)])).alias("x")
    rows = p.select("*", model).withColumn("seq", F.explode(F.when(key % 6 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    arrived = (key * 7 + F.col("x.i") * 3) % 8 != 0

    def of(name, value):
        return F.when(F.col("x.m") == name, value)

    anomaly = F.col("anomaly_raw")
    return rows.filter(arrived).select(
        "request_id", F.col("x.m").alias("model_type"), "seq",
        of("credit_risk", F.col("probability_of_default") + F.col("seq") / 100.0).alias("probability_of_default"),
        of("fraud_detection", -anomaly).alias("fraud_anomaly_score"),
        of("fraud_detection", case([(anomaly < -0.68, "HIGH"), (anomaly < -0.6, "MEDIUM")], "LOW")).alias("fraud_risk_flag"),
        of("loan_amount", F.col("recommended_loan_amount")).alias("recommended_loan_amount"),
        of("income_verification", F.col("income_tier")).alias("income_tier"),
        of("income_verification", F.col("income_confidence")).alias("income_confidence"))


def contexts(spark, d):
    key = F.col("c_custkey")
    raw = F.get(F.array(F.lit("all"), F.lit("credit_risk"), F.lit("fraud_detection,loan_amount"), F.lit("all"), F.lit("all")), (key % 5).cast("int"))
    return table(spark, d, "customer").select(
        F.concat(F.lit("REQ-"), key).alias("request_id"), batches.model_subset(raw).alias("models"), (raw != "all").alias("selective"),
        _label(F.floor(key / 5) % 5).alias("decision_label"))


_CTX = """SELECT k, rid, subset <> 'all' AS selective, label, CASE WHEN subset = 'credit_risk' THEN [0] WHEN subset <> 'all' THEN [1, 2] ELSE [0, 1, 2, 3] END AS wanted,
  list_filter([0, 1, 2, 3], lambda i: (k * 7 + i * 3) % 8 <> 0) AS present,
  pd + CASE WHEN k % 6 = 1 THEN 2 ELSE 1 END / 100e0 AS pd, CASE WHEN raw < -0.68e0 THEN 'HIGH' WHEN raw < -0.6e0 THEN 'MEDIUM' ELSE 'LOW' END AS flag, amount, tier
FROM (SELECT c_custkey AS k, 'REQ-' || c_custkey AS rid, (['all','credit_risk','fraud_detection,loan_amount','all','all'])[c_custkey % 5 + 1] AS subset,
  (['APPROVE','CONDITIONAL_APPROVE','REFER','DECLINE','FRAUD_HOLD'])[(c_custkey // 5) % 5 + 1] AS label, p.probability_of_default AS pd, p.anomaly_raw AS raw,
  p.recommended_loan_amount AS amount, p.income_tier AS tier FROM customer JOIN prediction p ON c_custkey = p.applicant_id)"""
_STATE = """SELECT *, coalesce(list_contains(present, 1) AND flag = 'HIGH', false) OR label IN ('DECLINE', 'REFER') AS skip,
  len(list_filter(wanted, lambda i: NOT list_contains(present, i))) AS lacking FROM ctx"""
_COLLECTED = """SELECT *, CASE WHEN selective THEN CASE WHEN lacking > 0 THEN 'waiting' ELSE 'decide' END
  WHEN NOT (list_contains(present, 0) AND list_contains(present, 1)) THEN 'waiting'
  WHEN skip OR (list_contains(present, 2) AND list_contains(present, 3)) THEN 'decide' ELSE 'trigger_phase_2' END AS state FROM st"""
_COL = {"ctx": _CTX, "st": _STATE, "got": _COLLECTED}


@query("collect_predictions", sql("""SELECT rid AS request_id, state, CASE WHEN list_contains(present, 0) THEN round(pd, 6) ELSE 0.5e0 END AS probability_of_default,
  CASE WHEN list_contains(present, 1) THEN flag ELSE 'LOW' END AS fraud_risk_flag,
  CASE WHEN list_contains(present, 2) AND (selective OR NOT skip) THEN amount END AS recommended_loan_amount,
  CASE WHEN list_contains(present, 3) AND (selective OR NOT skip) THEN tier END AS income_tier FROM got""", **_COL))
def collect_predictions(spark, d):
    collected = collect.collect(contexts(spark, d), collect.pivot_results(results(spark, d)))
    return collected.select("request_id", "state", F.round("probability_of_default", 6).alias("probability_of_default"),
                            "fraud_risk_flag", "recommended_loan_amount", "income_tier")


@query("phase2_eligible", sql("SELECT rid AS request_id FROM got WHERE NOT selective AND list_contains(present, 0) AND list_contains(present, 1) AND NOT skip", **_COL))
def phase2_eligible(spark, d):
    """Requests whose second phase runs: phase one complete, not held, not declined or referred."""
    return _gated(spark, d, False)


@query("phase2_skipped", sql("SELECT rid AS request_id FROM got WHERE NOT selective AND list_contains(present, 0) AND list_contains(present, 1) AND skip", **_COL))
def phase2_skipped(spark, d):
    return _gated(spark, d, True)


def _gated(spark, d, skipped):
    joined = contexts(spark, d).filter("not selective").join(collect.pivot_results(results(spark, d)), "request_id")
    ready = F.array_contains("present", "credit_risk") & F.array_contains("present", "fraud_detection")
    skip = collect.skip_phase_two(F.col("fraud_risk_flag"), F.col("decision_label"))
    return joined.filter(ready & (skip if skipped else ~skip)).select("request_id")


@query("scoring_response", sql(f"""SELECT request_id, final AS decision, CASE WHEN final = 'CONDITIONAL_APPROVE' THEN {_conditions_sql('recommended_loan_amount')} ELSE '' END AS conditions,
  round(probability_of_default, 4) AS pd, fraud_flag AS fraud_flag, recommended_loan_amount AS amount, (['LOW','MID','UPPER_MID','HIGH'])[income_tier + 1] AS income_label,
  credit_score, true AS keeps_nulls FROM final""", engine=_ENGINE, final=_FINAL))
def scoring_response(spark, d):
    """Response envelope as JSON text, read back field by field; null sub-objects stay in the text."""
    rows = _engine_input(spark, d)
    found = _decided(rows)
    body = F.struct(
        "request_id", found["final_decision"].alias("decision"), found["final_conditions"].alias("condition_applied"),
        F.struct("probability_of_default", dec.confidence(F.col("probability_of_default")).alias("pd_confidence"),
                 found["final_risk_tier"].alias("risk_tier"), F.lit(None).cast("string").alias("model_version")).alias("credit_risk"),
        F.struct((-F.col("anomaly_raw")).alias("fraud_anomaly_score"), "fraud_risk_flag").alias("fraud_detection"),
        F.struct(F.col("recommended_loan_amount").alias("recommended_amount_ghs"),
                 found["final_recommended_loan_tier"].alias("recommended_loan_tier")).alias("loan_amount"),
        F.struct("income_tier", dec.income_label(F.col("income_tier")).alias("income_tier_label"), "income_confidence").alias("income_verification"),
        F.struct("credit_score", "score_grade", "data_quality_score", F.col("hit_status").alias("bureau_hit_status"),
                 features.product_source().alias("product_source"),
                 F.col("applicant_age_years").alias("applicant_age_at_application")).alias("scoring_metadata"),
        found["final_refer_reasons"].alias("refer_reasons"))
    text = rows.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))

    def at(path):
        return F.get_json_object("value", path)

    parsed = F.from_json(at("$.condition_applied"), "array<string>")
    return text.select(
        at("$.request_id").alias("request_id"), at("$.decision").alias("decision"), F.array_join(parsed, "|").alias("conditions"),
        F.round(at("$.credit_risk.probability_of_default").cast("double"), 4).alias("pd"),
        at("$.fraud_detection.fraud_risk_flag").alias("fraud_flag"),
        at("$.loan_amount.recommended_amount_ghs").cast("double").alias("amount"),
        at("$.income_verification.income_tier_label").alias("income_label"),
        at("$.scoring_metadata.credit_score").cast("int").alias("credit_score"),
        F.col("value").contains('"model_version":null').alias("keeps_nulls"))


@query("handoff_events", sql("""SELECT topic, count(*) AS n, count(DISTINCT request_id) AS requests FROM (
  SELECT request_id, 'inference-request' AS topic FROM scored UNION ALL SELECT request_id, 'scoring-complete' FROM scored WHERE stop_code IS NOT NULL) GROUP BY 1"""))
def handoff_events(spark, d):
    """Envelopes per topic: every request to the models, hard stops also straight to the back end."""
    topics = F.array_compact(F.array(F.lit("inference-request"), F.when(F.col("hard_stop_triggered"), F.lit("scoring-complete"))))
    rows = facts.decisions(spark, d).select("request_id", F.explode(topics).alias("topic"), F.to_json(F.struct(
        "request_id", F.struct(*catalog.FEATURES).alias("features"),
        F.struct("credit_score", "score_grade", F.col("decision").alias("decision_label")).alias("metadata"))).alias("value"))
    return rows.groupBy("topic").agg(
        F.count_if(F.col("value").startswith('{"request_id":')).alias("n"), F.count_distinct("request_id").alias("requests"))


# --- audit and lookups ---------------------------------------------------------------------------------------------


def decisions_log(spark, d):
    """Decision records from purchase events."""
    return table(spark, d, "events").filter("event_type = 'purchase'").select(
        F.concat(F.lit("REQ-"), "user_id").alias("request_id"), F.to_date("ts").alias("decision_date"),
        F.col("event_id").alias("audit_id"), _label(F.col("event_id") % 5).alias("decision"))


@query("audit_append", sql("""SELECT strftime(decision_date, '%Y-%m-%d') AS decision_date, kind, count(*) AS n FROM (
  SELECT DISTINCT user_id, CAST(ts AS DATE) AS decision_date, 'decision' AS kind FROM events WHERE event_type = 'purchase'
  UNION SELECT DISTINCT user_id, CAST(ts AS DATE), 'error' FROM events WHERE event_type = 'purchase' AND event_id % 7 = 0) GROUP BY 1, 2"""))
def audit_append(spark, d):
    """Two deliveries of the log into a date-partitioned table: the second adds only what is new."""
    path = scratch.folder(spark, "audit")
    log = decisions_log(spark, d)
    keys = ["request_id", "decision_date", "kind"]
    errors = log.filter("audit_id % 7 = 0").withColumn("kind", F.lit("error"))
    rows = log.withColumn("kind", F.lit("decision")).unionByName(errors)
    rows.filter("audit_id % 2 = 0").dropDuplicates(keys).write.partitionBy("decision_date").parquet(path)
    stored = spark.read.parquet(path)
    registry.not_yet_stored(rows, stored, keys).write.mode("append").partitionBy("decision_date").parquet(path)
    return spark.read.parquet(path).groupBy(F.date_format("decision_date", "yyyy-MM-dd").alias("decision_date"), "kind").agg(
        F.count(F.lit(1)).alias("n"))


@query("audit_lookup", sql("""SELECT l.request_id, strftime(l.asked_on, '%Y-%m-%d') AS asked_on, strftime(a.decision_date, '%Y-%m-%d') AS decision_date, a.audit_id
FROM (SELECT DISTINCT 'REQ-' || user_id AS request_id, CAST(ts AS DATE) AS asked_on FROM events WHERE event_type = 'error') l
LEFT JOIN LATERAL (SELECT CAST(ts AS DATE) AS decision_date, event_id AS audit_id FROM events e WHERE e.event_type = 'purchase' AND 'REQ-' || e.user_id = l.request_id
  AND CAST(e.ts AS DATE) BETWEEN l.asked_on - 30 AND l.asked_on ORDER BY 1 DESC, 2 DESC LIMIT 1) a ON true"""))
def audit_lookup(spark, d):
    lookups = table(spark, d, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("REQ-"), "user_id").alias("request_id"), F.to_date("ts").alias("asked_on")).distinct()
    found = registry.visible_decisions(decisions_log(spark, d), lookups)
    return found.select("request_id", F.date_format("asked_on", "yyyy-MM-dd").alias("asked_on"),
                        F.date_format("decision_date", "yyyy-MM-dd").alias("decision_date"), "audit_id")


@query("reason_codes_lookup", sql("""SELECT feature, code, text FROM (SELECT feature, CASE feature
  WHEN 'utilisation_ratio' THEN 'R02' WHEN 'credit_age_months' THEN 'R03' WHEN 'num_accounts_total' THEN 'R03' WHEN 'total_outstanding_debt_ghs' THEN 'R04'
  WHEN 'total_monthly_instalment_ghs' THEN 'R04' WHEN 'num_enquiries_3m' THEN 'R05' WHEN 'num_enquiries_12m' THEN 'R05' WHEN 'has_active_arrears' THEN 'R06'
  WHEN 'total_arrear_amount_ghs' THEN 'R06' WHEN 'has_employer_detail' THEN 'R07' WHEN 'num_dependants' THEN 'R07' WHEN 'product_diversity_score' THEN 'R09'
  WHEN 'num_closed_accounts_good' THEN 'R09' WHEN 'highest_delinquency_rating' THEN 'R01' WHEN 'months_on_time_24m' THEN 'R01' WHEN 'worst_arrears_24m' THEN 'R01'
  WHEN 'current_streak_on_time' THEN 'R01' WHEN 'has_adverse_default' THEN 'R08' WHEN 'has_written_off' THEN 'R08' WHEN 'has_charged_off' THEN 'R08'
  WHEN 'has_legal_handover' THEN 'R08' WHEN 'has_judgement' THEN 'R08' END AS code FROM (SELECT DISTINCT ([""" + ", ".join(f"'{n}'" for n in FEATURE_NAMES) + """])[l_partkey % 30 + 1] AS feature FROM lineitem))
LEFT JOIN (VALUES ('R01','Delinquency history'),('R02','High credit utilisation'),('R03','Limited credit history'),('R04','High outstanding debt'),('R05','Multiple recent enquiries'),
  ('R06','Active arrears present'),('R07','Low income indicators'),('R08','Adverse account records'),('R09','Limited account diversity'),('R10','High monthly obligations')) t(c, text) ON c = code"""))
def reason_codes_lookup(spark, d):
    """Code and text per feature named by the explanation rows."""
    named = table(spark, d, "lineitem").select(_feature_name(F.col("l_partkey")).alias("feature")).distinct()
    rows = [(f, c, catalog.REASON_TEXT[c]) for f, c in catalog.REASON_CODES.items()]
    codes = spark.createDataFrame(rows, "feature string, code string, text string")
    return named.join(F.broadcast(codes), "feature", "left").select("feature", "code", "text")


def _feature_name(key):
    return F.get(F.array(*[F.lit(f) for f in catalog.FEATURES]), (key % 30).cast("int"))


# --- model outputs ---------------------------------------------------------------------------------------------------


@query("platt_scale", sql("""SELECT request_id, round(1 / (1 + exp(-(2.5e0 * probability_of_default + -1.2e0))), 6) AS calibrated,
  round(greatest(1 / (1 + exp(-(2.5e0 * probability_of_default + -1.2e0))), 1 - 1 / (1 + exp(-(2.5e0 * probability_of_default + -1.2e0)))), 6) AS confidence FROM prediction"""))
def platt_scale(spark, d):
    p = dec.platt(F.col("probability_of_default"), 2.5, -1.2)
    return views.predictions(spark, d).select("request_id", F.round(p, 6).alias("calibrated"), F.round(dec.confidence(p), 6).alias("confidence"))


def fraud_limits(scores):
    """One row with the 1st and 5th percentile, minimum and maximum of ``anomaly_raw``."""
    counts = ranking.value_counts(scores.select(F.lit("anomaly").alias("key"), F.col("anomaly_raw").alias("value")), ["key"], "anomaly-counts")
    cuts = ranking.quantiles_of_counts(counts, ["key"], [0.01, 0.05])
    ends = counts.agg(F.min("value").alias("min_score"), F.max("value").alias("max_score"))
    return cuts.agg(F.max(F.when(F.col("share") == 0.01, F.col("quantile"))).alias("p1"),
                    F.max(F.when(F.col("share") == 0.05, F.col("quantile"))).alias("p5")).crossJoin(F.broadcast(ends))  # one row each


def flagged(scores):
    """Normalised score and flag per request."""
    raw = F.col("anomaly_raw")
    return scores.crossJoin(F.broadcast(fraud_limits(scores))).select(  # one row of limits
        "request_id", F.round(dec.anomaly_score(raw, F.col("min_score"), F.col("max_score")), 6).alias("fraud_anomaly_score"),
        dec.fraud_flag(raw, F.col("p1"), F.col("p5")).alias("fraud_risk_flag"))


@query("fraud_flags", sql("""SELECT request_id, round(1 - (anomaly_raw - lo) / (hi - lo), 6) AS fraud_anomaly_score,
  CASE WHEN anomaly_raw < p1 THEN 'HIGH' WHEN anomaly_raw < p5 THEN 'MEDIUM' ELSE 'LOW' END AS fraud_risk_flag
FROM prediction, (SELECT quantile_cont(anomaly_raw, 0.01) AS p1, quantile_cont(anomaly_raw, 0.05) AS p5, min(anomaly_raw) AS lo, max(anomaly_raw) AS hi FROM prediction)"""))
def fraud_flags(spark, d):
    return flagged(views.predictions(spark, d))


@query("fraud_thresholds", sql("""SELECT round(quantile_cont(anomaly_raw, 0.01), 6) AS p1, round(quantile_cont(anomaly_raw, 0.05), 6) AS p5,
  min(anomaly_raw) AS min_score, max(anomaly_raw) AS max_score FROM prediction"""))
def fraud_thresholds(spark, d):
    limits = fraud_limits(views.predictions(spark, d))
    return limits.select(F.round("p1", 6).alias("p1"), F.round("p5", 6).alias("p5"), "min_score", "max_score")


@query("fraud_distribution", sql("""SELECT round(avg(CASE WHEN f = 'LOW' THEN 1e0 ELSE 0e0 END), 4) AS low_pct, round(avg(CASE WHEN f = 'MEDIUM' THEN 1e0 ELSE 0e0 END), 4) AS medium_pct,
  round(avg(CASE WHEN f = 'HIGH' THEN 1e0 ELSE 0e0 END), 4) AS high_pct,
  avg(CASE WHEN f = 'LOW' THEN 1e0 ELSE 0e0 END) BETWEEN 0.90 AND 0.95 AND avg(CASE WHEN f = 'MEDIUM' THEN 1e0 ELSE 0e0 END) BETWEEN 0.04 AND 0.08
    AND avg(CASE WHEN f = 'HIGH' THEN 1e0 ELSE 0e0 END) BETWEEN 0.005 AND 0.02 AS as_expected
FROM (SELECT CASE WHEN anomaly_raw < p1 THEN 'HIGH' WHEN anomaly_raw < p5 THEN 'MEDIUM' ELSE 'LOW' END AS f
  FROM prediction, (SELECT quantile_cont(anomaly_raw, 0.01) AS p1, quantile_cont(anomaly_raw, 0.05) AS p5 FROM prediction))"""))
def fraud_distribution(spark, d):
    def share(flag):
        return F.avg(F.when(F.col("fraud_risk_flag") == flag, 1.0).otherwise(0.0))

    shares = fraud_flags(spark, d).agg(share("LOW").alias("low"), share("MEDIUM").alias("medium"), share("HIGH").alias("high"))
    # Expected ranges of the flag shares.
    fine = F.col("low").between(0.90, 0.95) & F.col("medium").between(0.04, 0.08) & F.col("high").between(0.005, 0.02)
    return shares.select(*[F.round(n, 4).alias(f"{n}_pct") for n in ("low", "medium", "high")], fine.alias("as_expected"))


@query("fraud_sanity", sql("""SELECT bad, count(*) AS n, round(avg(anomaly_raw), 4) AS mean_score FROM (
  SELECT f.*, p.anomaly_raw, coalesce(has_written_off, 0) > 0.5 OR coalesce(has_charged_off, 0) > 0.5 OR coalesce(has_legal_handover, 0) > 0.5 AS bad
  FROM feature f JOIN prediction p USING (applicant_id)) GROUP BY 1"""))
def fraud_sanity(spark, d):
    """Mean score of applicants with adverse events against the clean ones."""
    bad = F.greatest(*[F.coalesce(f, F.lit(0.0)) for f in ("has_written_off", "has_charged_off", "has_legal_handover")]) > 0.5
    p = views.predictions(spark, d).select("applicant_id", "anomaly_raw")
    return facts.feature_table(spark, d).join(p, "applicant_id").groupBy(bad.alias("bad")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("anomaly_raw"), 4).alias("mean_score"))


_INC = "[(k * 7) % 10 + 1, (k * 11) % 10 + 1, (k * 13) % 10 + 1, (k * 17) % 10 + 1]"


@query("income_labels", sql(f"""SELECT 'REQ-' || k AS request_id, CAST(list_position(w, list_max(w)) - 1 AS INTEGER) AS income_tier,
  (['LOW','MID','UPPER_MID','HIGH'])[list_position(w, list_max(w))] AS income_tier_label, round(list_max(w) / list_sum(w), 6) AS income_confidence
FROM (SELECT c_custkey AS k, [(c_custkey * 7) % 10 + 1, (c_custkey * 11) % 10 + 1, (c_custkey * 13) % 10 + 1, (c_custkey * 17) % 10 + 1] AS w FROM customer)"""))
def income_labels(spark, d):
    key = F.col("c_custkey")
    weights = [key * m % 10 + 1 for m in (7, 11, 13, 17)]
    total = weights[0] + weights[1] + weights[2] + weights[3]
    tier, confidence = dec.best_class(F.array(*[w / total for w in weights]))
    return table(spark, d, "customer").select(
        F.concat(F.lit("REQ-"), key).alias("request_id"), tier.alias("income_tier"), dec.income_label(tier).alias("income_tier_label"),
        F.round(confidence, 6).alias("income_confidence"))


@query("top_contributions", sql("""SELECT k AS key, string_agg(feature, ',' ORDER BY rn) AS top_features, string_agg(direction, ',' ORDER BY rn) AS directions FROM (
  SELECT k, feature, CASE WHEN v > 0 THEN 'positive' ELSE 'negative' END AS direction, row_number() OVER (PARTITION BY k ORDER BY abs(v) DESC, i) AS rn
  FROM (SELECT c_custkey AS k, i, ([""" + ", ".join(f"'{n}'" for n in FEATURE_NAMES) + """])[i + 1] AS feature, ((c_custkey * 31 + i * 17) % 101 - 50) / 100e0 AS v FROM customer, range(0, 30) r(i)))
WHERE rn <= 5 GROUP BY 1"""))
def top_contributions(spark, d):
    """Five largest contributions by size per row, with direction, from an array column; no shuffle."""
    key = F.col("c_custkey")
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), ((key * 31 + i * 17) % 101 - 50).cast("double").alias("value"))
                        for i, f in enumerate(catalog.FEATURES)])
    scaled = F.transform(entries, lambda e: F.struct(e["feature"].alias("feature"), (e["value"] / 100).alias("value")))
    top = top_five(scaled)
    return table(spark, d, "customer").select(key.alias("key"), top.alias("top")).select(
        "key", F.array_join(F.transform("top", lambda t: t["feature"]), ",").alias("top_features"),
        F.array_join(F.transform("top", lambda t: F.when(t["value"] > 0, F.lit("positive")).otherwise("negative")), ",").alias("directions"))


def top_five(entries):
    """First five of an array of (feature, value) by absolute value, earlier entries first on ties."""
    ranked = F.transform(entries, lambda e, i: F.struct((-F.abs(e["value"])).alias("s"), i.alias("i"), e["feature"].alias("feature"), e["value"].alias("value")))
    return F.slice(F.array_sort(ranked), 1, 5)


def reason_codes(top):
    """Distinct reason codes of the top features, in their order."""
    lookup = F.create_map(*[F.lit(x) for pair in catalog.REASON_CODES.items() for x in pair])
    return F.slice(F.array_distinct(F.array_compact(F.transform(top, lambda t: lookup[t["feature"]]))), 1, 5)
