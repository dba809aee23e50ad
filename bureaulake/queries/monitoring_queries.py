"""Queries: drift, fairness, model metrics, registry, jobs, operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions.bins import case
from bureaulake.operators import batches, context, features, metrics, monitoring, registry
from bureaulake.plans import facts
from bureaulake.queries import decision_queries as dq
from bureaulake.queries.ctes import FEATURE_NAMES, FEATURE_SQL, _imputed, sql
from bureaulake.queries.decision_queries import _feature_name
from bureaulake.queries.scoring_queries import _FLAG
from bureaulake.functions import accounts as acc
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


# --- drift ---------------------------------------------------------------------------------------------------


def cohorts(spark, d):
    """Features of a baseline and a recent cohort; money is 1.5 times as high in the recent one."""
    recent = F.floor(F.col("applicant_id") / 40) % 2 == 1
    raised = facts.applicant_facts(spark, d).withColumn("cohort", F.when(recent, F.lit("recent")).otherwise("baseline"))
    scale = F.when(F.col("cohort") == "recent", F.lit(1.5)).otherwise(1.0)
    raised = raised.withColumns({n: F.col(n) * scale for n in ("outstanding_debt", "instalment_45", "arrear_amount", "mobile_max")})
    return features.feature_vector(raised)


_COHORT_FACT = """SELECT * REPLACE (outstanding_debt * f AS outstanding_debt, instalment_45 * f AS instalment_45, arrear_amount * f AS arrear_amount, mobile_max * f AS mobile_max)
FROM (SELECT *, CASE WHEN (applicant_id // 40) % 2 = 1 THEN 'recent' ELSE 'baseline' END AS cohort, CASE WHEN (applicant_id // 40) % 2 = 1 THEN 1.5e0 ELSE 1e0 END AS f FROM fact)"""
_COHORT = "SELECT cohort, " + ", ".join(f"{_imputed(n)} AS {n}" for n in FEATURE_NAMES) + " FROM cohort_fact"
_LONG = "SELECT cohort, feature, value FROM (SELECT cohort, " + ", ".join(FEATURE_NAMES) + " FROM cohort) UNPIVOT (value FOR feature IN (" + ", ".join(FEATURE_NAMES) + "))"
_BIN = "CASE WHEN value BETWEEN 0 AND 1 THEN CASE " + " ".join(f"WHEN value >= {i} * 0.1e0 THEN {i}" for i in range(9, 0, -1)) + " ELSE 0 END END"
_HIST = f"SELECT cohort, feature, {_BIN} AS bin, count(*) AS n FROM long_feature GROUP BY 1, 2, 3"
_PSI = """SELECT feature, sum((a - e) * ln(a / e)) AS raw_psi FROM (
  SELECT t.feature, b.bin, coalesce(eh.n, 0) / t.e_total::DOUBLE + 1e-6 AS e, coalesce(ah.n, 0) / t.a_total::DOUBLE + 1e-6 AS a
  FROM (SELECT feature, sum(n) FILTER (cohort = 'baseline') AS e_total, sum(n) FILTER (cohort = 'recent') AS a_total FROM hist GROUP BY 1) t
  CROSS JOIN (SELECT unnest(range(0, 10)) AS bin) b
  LEFT JOIN hist eh ON eh.cohort = 'baseline' AND eh.feature = t.feature AND eh.bin = b.bin
  LEFT JOIN hist ah ON ah.cohort = 'recent' AND ah.feature = t.feature AND ah.bin = b.bin WHERE t.a_total >= 10) GROUP BY 1"""
_SEV = """SELECT *, CASE WHEN raw_psi >= 0.2 THEN CASE WHEN feature IN ('highest_delinquency_rating','months_on_time_24m','worst_arrears_24m','current_streak_on_time','has_active_arrears','total_arrear_amount_ghs') THEN 'HIGH' ELSE 'MEDIUM' END
  WHEN raw_psi >= 0.1 THEN 'MINOR' ELSE 'NONE' END AS severity FROM psi"""
_DRIFT = {"cohort_fact": _COHORT_FACT, "cohort": _COHORT, "long_feature": _LONG, "hist": _HIST, "psi": _PSI, "sev": _SEV}


@query("feature_histograms", sql("SELECT cohort, feature, bin, n FROM hist", **_DRIFT))
def feature_histograms(spark, d):
    return monitoring.histograms(cohorts(spark, d), ["cohort"])


def _psi(spark, d):
    return monitoring.cohort_psi(monitoring.histograms(cohorts(spark, d), ["cohort"]), "baseline", "recent")


@query("psi", sql("SELECT feature, round(raw_psi, 4) AS psi, severity FROM sev", **_DRIFT))
def psi(spark, d):
    return _psi(spark, d).select("feature", "psi", "severity")


@query("drift_verdict", sql("""SELECT count(*) FILTER (severity IN ('HIGH', 'MEDIUM')) AS drifted, count(*) FILTER (severity = 'MINOR') AS minor, bool_or(severity = 'HIGH') AS has_group_a_drift,
  CASE WHEN bool_or(severity = 'HIGH') OR count(*) FILTER (severity IN ('HIGH', 'MEDIUM')) >= 3 THEN 'retrain' ELSE 'monitor' END AS recommendation FROM sev""", **_DRIFT))
def drift_verdict(spark, d):
    return monitoring.verdict(_psi(spark, d)).drop("models_to_retrain")


@query("drift_retrain", sql("""SELECT concat_ws(',', 'credit_risk',
  CASE WHEN bool_or(severity IN ('HIGH', 'MEDIUM') AND feature IN ('total_outstanding_debt_ghs', 'utilisation_ratio', 'total_monthly_instalment_ghs')) THEN 'loan_amount' END,
  CASE WHEN bool_or(severity IN ('HIGH', 'MEDIUM') AND feature IN ('has_employer_detail', 'total_monthly_instalment_ghs', 'credit_age_months')) THEN 'income_verification' END, 'fraud_detection') AS models FROM sev""", **_DRIFT))
def drift_retrain(spark, d):
    return monitoring.verdict(_psi(spark, d)).select(F.array_join("models_to_retrain", ",").alias("models"))


@query("trailing_7d", """SELECT *, rows_7d >= 50 AS enough FROM (SELECT day, sum(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)::BIGINT AS rows_7d,
  round(sum(s) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4) AS value_7d FROM (
  SELECT date_trunc('day', ts)::DATE AS day, count(*) AS n, sum(value) AS s FROM events GROUP BY 1))""".replace("SELECT day,", "SELECT strftime(day, '%Y-%m-%d') AS day,", 1))
def trailing_7d(spark, d):
    """Rows and values of the seven days up to each day, and whether there are the 50 rows that drift is judged from.

    Days are summed first.  Each daily sum then counts towards the seven days it belongs to, so the second
    step is a plain aggregation over days and no window runs over the whole table.
    """
    daily = table(spark, d, "events").groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    spread = daily.select("n", "s", "d", F.explode(F.sequence("d", F.date_add("d", 6))).alias("day"))
    known = daily.select(F.col("d").alias("day"))
    return spread.join(known, "day", "left_semi").groupBy("day").agg(
        F.sum("n").alias("rows_7d"), F.round(F.sum("s"), 4).alias("value_7d")).withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "enough": F.col("rows_7d") >= monitoring.LEAST_ROWS})


# --- fairness --------------------------------------------------------------------------------------------------


def judged(spark, d):
    """Age group, default flag and thresholded model output per applicant."""
    vectors = facts.feature_table(spark, d).join(views.predictions(spark, d).drop("request_id"), "applicant_id")
    return vectors.select(
        "request_id", "applicant_age", monitoring.age_group(F.col("applicant_age")).alias("age_group"),
        acc.default_flag().alias("actual"), (F.col("probability_of_default") >= 0.5).cast("int").alias("predicted"))


_JUDGED = f"""SELECT request_id, CASE WHEN applicant_age IS NULL THEN 'UNKNOWN' WHEN applicant_age = 0 THEN 'INELIGIBLE' WHEN applicant_age = 0.7e0 THEN 'YOUNG' WHEN applicant_age = 1 THEN 'PRIME'
  WHEN applicant_age = 0.9e0 THEN 'MATURE' WHEN applicant_age = 0.65e0 THEN 'SENIOR' END AS age_group, {_FLAG} AS actual, CAST(probability_of_default >= 0.5 AS INTEGER) AS predicted
FROM feature JOIN (SELECT applicant_id, probability_of_default FROM prediction) p USING (applicant_id)"""
_RATES = "SELECT age_group, count(*) AS n, avg(predicted) AS rate FROM judged WHERE age_group NOT IN ('INELIGIBLE', 'UNKNOWN') GROUP BY 1 HAVING count(*) >= 10"
_DI = "SELECT count(*) AS groups, round(min(rate) / max(rate), 4) AS di_ratio, min(rate) / max(rate) < 0.8 AS di_violation FROM rates"
_FNR = """SELECT age_group, count(*) FILTER (actual = 1) AS positives, round(count(*) FILTER (actual = 1 AND predicted = 0) / count(*) FILTER (actual = 1)::DOUBLE, 4) AS fnr
FROM judged WHERE age_group NOT IN ('INELIGIBLE', 'UNKNOWN') GROUP BY 1 HAVING count(*) FILTER (actual = 1) >= 5"""
_EO = "SELECT count(*) AS groups, round(max(fnr) - min(fnr), 4) AS max_gap, max(fnr) - min(fnr) > 0.1 AS eo_violation FROM fnr"
_FAIR = {"judged": _JUDGED, "rates": _RATES, "di": _DI, "fnr": _FNR, "eo": _EO}


@query("age_groups", sql("SELECT age_group, count(*) AS n FROM judged GROUP BY 1", **_FAIR))
def age_groups(spark, d):
    return judged(spark, d).groupBy("age_group").agg(F.count(F.lit(1)).alias("n"))


@query("disparate_impact", sql("SELECT * FROM di", **_FAIR))
def disparate_impact(spark, d):
    return monitoring.disparate_impact(monitoring.group_table(judged(spark, d)))


@query("equal_opportunity", sql("SELECT * FROM eo", **_FAIR))
def equal_opportunity(spark, d):
    return monitoring.equal_opportunity(monitoring.group_table(judged(spark, d)))


@query("fairness_report", sql("""SELECT di_ratio, di_violation, max_gap, eo_violation, CAST(di_violation AS INTEGER) + CAST(eo_violation AS INTEGER) AS violations,
  NOT di_violation AND NOT eo_violation AS passed FROM di JOIN eo ON true""", **_FAIR))
def fairness_report(spark, d):
    return monitoring.fairness_report(monitoring.group_table(judged(spark, d)))


# --- model metrics -----------------------------------------------------------------------------------------------


def scored_orders(spark, d):
    """Labels and scores by formula, one row per order."""
    key = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        key.alias("key"), (key * 7 % 10 < 4).cast("int").alias("label"), ((key * 37 % 1000 + key * 7 % 10 * 60) / 1600.0).alias("score"),
        (key % 4).cast("int").alias("tier"), F.col("o_totalprice").alias("actual"))


_SCORED = """SELECT o_orderkey AS key, CAST(o_orderkey * 7 % 10 < 4 AS INTEGER) AS label, (o_orderkey * 37 % 1000 + o_orderkey * 7 % 10 * 60) / 1600e0 AS score,
  CAST(o_orderkey % 4 AS INTEGER) AS tier, o_totalprice AS actual FROM orders"""


def _auc_sql(source, label="label", score="score"):
    return f"""(SELECT sum(pos * (below + neg / 2e0)) / (sum(pos) * sum(neg)) FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT {score} AS s, count(*) FILTER ({label} = 1) AS pos, count(*) FILTER ({label} = 0) AS neg FROM {source} GROUP BY 1)))"""


@query("binary_metrics", sql(f"""SELECT tp, fp, fn, tn, round(tp / (tp + fp)::DOUBLE, 4) AS precision, round(tp / (tp + fn)::DOUBLE, 4) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 4) AS f1,
  round(ll, 4) AS log_loss, round({_auc_sql('labelled')}, 4) AS auc FROM (SELECT count(*) FILTER (label = 1 AND score >= 0.5) AS tp, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 0 AND score < 0.5) AS tn,
  avg(-CASE WHEN label = 1 THEN ln(least(greatest(score, 1e-15), 1 - 1e-15)) ELSE ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END) AS ll FROM labelled)""", labelled=_SCORED))
def binary_metrics(spark, d):
    names = ["precision", "recall", "f1", "log_loss", "auc"]
    return metrics.binary(scored_orders(spark, d)).select("tp", "fp", "fn", "tn", *[F.round(n, 4).alias(n) for n in names])


_GUESS = {"low": "(actual * 0.9e0 + 1000)", "high": "(actual * 1.05e0)"}
_REG = """SELECT '{n}' AS model, round(sqrt(avg((({g}) - actual) * (({g}) - actual))), 4) AS rmse, round(avg(abs(({g}) - actual)), 4) AS mae,
  round(1 - avg((({g}) - actual) * (({g}) - actual)) / var_pop(actual), 4) AS r2 FROM labelled"""


@query("regression_metrics", sql(" UNION ALL ".join(_REG.replace("{n}", n).replace("{g}", g) for n, g in {
    "low": "actual * 0.9e0 + 1000", "high": "actual * 1.05e0", "ensemble": "(actual * 0.9e0 + 1000 + actual * 1.05e0) / 2"}.items()), labelled=_SCORED))
def regression_metrics(spark, d):
    """Two members and their mean."""
    rows = scored_orders(spark, d).withColumns({"low": F.col("actual") * 0.9 + 1000, "high": F.col("actual") * 1.05})
    rows = rows.withColumn("ensemble", (F.col("low") + F.col("high")) / 2)
    parts = [metrics.regression(rows, m) for m in ("low", "high", "ensemble")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("model", *[F.round(n, 4).alias(n) for n in ("rmse", "mae", "r2")])


_CLASS = """SELECT c AS class, count(*) FILTER (tier = c) AS support, count(*) FILTER (guess = c) AS guessed, count(*) FILTER (tier = c AND guess = c) AS tp
FROM (SELECT key, tier, CAST((key % 4 + CASE WHEN key % 7 = 0 THEN 1 ELSE 0 END) % 4 AS INTEGER) AS guess FROM labelled), (SELECT unnest(range(0, 4)) AS c) GROUP BY 1"""


@query("multiclass_metrics", sql("""SELECT CAST(class AS INTEGER) AS class, support, round(tp / guessed::DOUBLE, 4) AS precision, round(tp / support::DOUBLE, 4) AS recall,
  round(2 * tp / (guessed + support)::DOUBLE, 4) AS f1, round(sum(2 * tp / (guessed + support)::DOUBLE * support) OVER () / sum(support) OVER (), 4) AS weighted_f1 FROM classes""", classes=_CLASS, labelled=_SCORED))
def multiclass_metrics(spark, d):
    key = F.col("key")
    rows = scored_orders(spark, d).select(F.col("tier").alias("label"), ((key % 4 + F.when(key % 7 == 0, 1).otherwise(0)) % 4).cast("int").alias("predicted"))
    classes = metrics.per_class(rows, 4)
    overall = classes.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    return classes.crossJoin(F.broadcast(overall)).select(
        "class", "support", *[F.round(n, 4).alias(n) for n in ("precision", "recall", "f1", "weighted_f1")])


@query("confusion_matrix", sql("""SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS predicted, count(tier) AS n FROM range(0, 4) x(a), range(0, 4) y(b) LEFT JOIN (
  SELECT tier, (key % 4 + CASE WHEN key % 7 = 0 THEN 1 ELSE 0 END) % 4 AS guess FROM labelled) ON tier = a AND guess = b GROUP BY 1, 2""", labelled=_SCORED))
def confusion_matrix(spark, d):
    """Four by four: actual against predicted tier."""
    key = F.col("key")
    rows = scored_orders(spark, d).select(F.col("tier").cast("int").alias("label"), ((key % 4 + F.when(key % 7 == 0, 1).otherwise(0)) % 4).cast("int").alias("predicted"))
    return metrics.confusion(rows, 4)


@query("multiclass_auc", sql("SELECT round(sum(support * a) / sum(support), 4) AS auc_ovr FROM (" + " UNION ALL ".join(
    f"SELECT (SELECT count(*) FROM labelled WHERE tier = {c}) AS support, {_auc_sql(f'ovr{c}')} AS a" for c in range(4)) + ")",
    labelled=_SCORED, **{f"ovr{c}": f"SELECT CAST(tier = {c} AS INTEGER) AS label, ((key * {c + 3} + CASE WHEN tier = {c} THEN 200 ELSE 0 END) % 997) / 1000e0 AS score FROM labelled" for c in range(4)}))
def multiclass_auc(spark, d):
    """Weighted one-versus-rest AUC: four rankings in one plan."""
    key = F.col("key")
    each = F.explode(F.array(*[F.struct(
        F.lit(c).alias("class"), (F.col("tier") == c).cast("int").alias("label"),
        ((key * (c + 3) + F.when(F.col("tier") == c, 200).otherwise(0)) % 997 / 1000.0).alias("score")) for c in range(4)])).alias("x")
    ranked = metrics.auc(scored_orders(spark, d).select(each).select("x.*"), ["class"])
    return ranked.agg(F.round(F.sum(F.col("positives") * F.col("auc")) / F.sum("positives"), 4).alias("auc_ovr"))


_MET = """SELECT 'credit_risk' AS model_type, 'auc' AS metric, count(*) FILTER (o_orderstatus = 'F') / count(*)::DOUBLE + 0.45e0 AS value FROM orders
UNION ALL SELECT 'credit_risk', 'log_loss', count(*) FILTER (o_orderstatus = 'O') / count(*)::DOUBLE FROM orders
UNION ALL SELECT 'loan_amount', 'mae', avg(o_totalprice) / 100 FROM orders UNION ALL SELECT 'loan_amount', 'r2', count(*) FILTER (o_orderstatus = 'P') / count(*)::DOUBLE FROM orders"""


@query("metric_gate", sql("""SELECT model_type, metric, round(value, 6) AS value, CASE metric WHEN 'auc' THEN value >= 0.78 WHEN 'log_loss' THEN value <= 0.5 WHEN 'mae' THEN value <= 1500 ELSE value >= 0.55 END AS passed,
  CASE WHEN metric = 'auc' AND value < 0.78 THEN 'below minimum' WHEN metric = 'log_loss' AND value > 0.5 THEN 'above maximum' WHEN metric = 'mae' AND value > 1500 THEN 'above maximum'
    WHEN metric = 'r2' AND value < 0.55 THEN 'below minimum' END AS problem FROM met""", met=_MET))
def metric_gate(spark, d):
    def share(status):
        return F.count_if(F.col("o_orderstatus") == status) / F.count(F.lit(1))

    found = table(spark, d, "orders").agg(F.array(
        *[F.struct(F.lit(m).alias("model_type"), F.lit(n).alias("metric"), v.alias("value")) for m, n, v in (
            ("credit_risk", "auc", share("F") + 0.45), ("credit_risk", "log_loss", share("O")),
            ("loan_amount", "mae", F.avg("o_totalprice") / 100), ("loan_amount", "r2", share("P")))]).alias("m"))
    limits = spark.createDataFrame(metrics.LIMITS, "model_type string, metric string, low double, high double")
    return metrics.gate(found.select(F.inline("m")), limits).withColumn("value", F.round("value", 6))


@query("class_balance", sql(f"""SELECT count(*) FILTER (f = 0) AS negatives, count(*) FILTER (f = 1) AS positives, round(count(*) FILTER (f = 0) / count(*) FILTER (f = 1)::DOUBLE, 6) AS scale_pos_weight FROM (SELECT {_FLAG} AS f FROM fact)"""))
def class_balance(spark, d):
    flag = F.col("actual")
    counts = judged(spark, d).agg(F.count_if(flag == 0).alias("negatives"), F.count_if(flag == 1).alias("positives"))
    weight = F.when(F.col("positives") == 0, F.lit(1.0)).otherwise(F.col("negatives") / F.when(F.col("positives") > 0, F.col("positives")))
    return counts.withColumn("scale_pos_weight", F.round(weight, 6))


_IMP = "SELECT ([" + ", ".join(f"'{n}'" for n in FEATURE_NAMES) + "])[l_partkey % 30 + 1] AS feature, CAST(sum(l_quantity) FILTER (l_partkey % 30 < 9 OR l_linenumber = 1) AS BIGINT) AS importance FROM lineitem GROUP BY 1"


def importance(spark, d):
    part = F.col("l_partkey")
    counted = (part % 30 < 9) | (F.col("l_linenumber") == 1)
    return table(spark, d, "lineitem").groupBy(_feature_name(part).alias("feature")).agg(
        F.sum(F.when(counted, F.col("l_quantity"))).cast("long").alias("importance"))


@query("importance_select", sql("""SELECT feature, importance, rank, round(share, 6) AS share, coalesce(lag(share) OVER (ORDER BY rank), 0) < 0.95 AS selected FROM (
  SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rank, sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) / (sum(importance) OVER ())::DOUBLE AS share FROM imp)""", imp=_IMP))
def importance_select(spark, d):
    return metrics.cumulative_share(importance(spark, d)).withColumn("share", F.round("share", 6))


@query("importance_top", sql("SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 15", imp=_IMP))
def importance_top(spark, d):
    return importance(spark, d).orderBy(F.desc("importance"), "feature").limit(15)


# --- registry -------------------------------------------------------------------------------------------------------


def model_versions(spark, d):
    """Version rows of three of the four model types."""
    key = F.col("o_orderkey")
    kind = F.get(F.array(*[F.lit(m) for m in catalog.MODELS[:3]]), (key % 3).cast("int"))
    return table(spark, d, "orders").select(
        kind.alias("model_type"), F.floor(key / 3).cast("string").alias("version"), (F.col("o_totalprice") % 1000 / 1000).alias("metric"),
        F.to_json(F.struct((F.col("o_totalprice") % 1000 / 1000).alias("auc"))).alias("metrics_json"))


_MV = """SELECT (['credit_risk','fraud_detection','loan_amount'])[o_orderkey % 3 + 1] AS model_type, o_orderkey // 3 AS version, o_totalprice % 1000 / 1000 AS metric FROM orders"""
_LM = "SELECT model_type, CAST(max(version) AS VARCHAR) AS version, arg_max(metric, version) AS metric FROM mv GROUP BY 1"


def _latest_models(spark, d):
    return registry.latest(model_versions(spark, d), ["model_type"], [F.col("version").cast("long")], ["version", "metric", "metrics_json"])


@query("latest_model", sql("SELECT model_type, version, round(metric, 6) AS metric FROM lm", mv=_MV, lm=_LM))
def latest_model(spark, d):
    return _latest_models(spark, d).select("model_type", "version", F.round("metric", 6).alias("metric"))


@query("champion_snapshot", sql("""SELECT m AS model_type, version, CASE WHEN version IS NULL THEN 'NOT_REGISTERED' ELSE 'CHAMPION' END AS status, round(metric, 6) AS auc
FROM (VALUES ('credit_risk'), ('fraud_detection'), ('loan_amount'), ('income_verification')) t(m) LEFT JOIN lm ON m = model_type""", mv=_MV, lm=_LM))
def champion_snapshot(spark, d):
    shot = registry.champion_snapshot(spark, _latest_models(spark, d))
    parsed = F.from_json("metrics_json", "map<string,double>")["auc"]
    return shot.select("model_type", "version", "status", F.round(parsed, 6).alias("auc"))


@query("champion_challenger", sql("""SELECT c.model_type, round(new_value, 6) AS new_value, version AS champion_version, round(metric, 6) AS champion_value, metric IS NULL OR new_value >= metric AS promote FROM (
  SELECT (['credit_risk','fraud_detection','loan_amount','income_verification'])[c_custkey % 4 + 1] AS model_type, max(c_acctbal) / 10000 AS new_value FROM customer GROUP BY 1) c LEFT JOIN lm USING (model_type)""", mv=_MV, lm=_LM))
def champion_challenger(spark, d):
    kind = F.get(F.array(*[F.lit(m) for m in catalog.MODELS]), (F.col("c_custkey") % 4).cast("int"))
    new = table(spark, d, "customer").groupBy(kind.alias("model_type")).agg((F.max("c_acctbal") / 10000).alias("metric"))
    return registry.champion_gate(new, _latest_models(spark, d)).withColumns(
        {n: F.round(n, 6) for n in ("new_value", "champion_value")})


def mappings(spark, d):
    ev = F.col("event_id")
    return table(spark, d, "events").select(
        F.concat(F.lit("bank-"), F.col("user_id") % 40).alias("bank_id"), F.col("event_type").alias("schema_hash"),
        (ev % 7).cast("int").alias("version"), ev)


_MAP = "SELECT 'bank-' || (user_id % 40) AS bank_id, event_type AS schema_hash, CAST(event_id % 7 AS INTEGER) AS version, event_id FROM events"
_MINI = "SELECT *, row_number() OVER (PARTITION BY bank_id, schema_hash, version ORDER BY event_id) - 1 AS mini_version FROM map"
_LATEST_MAP = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bank_id, schema_hash ORDER BY version DESC, mini_version DESC) AS rn FROM mini) WHERE rn = 1"


def _numbered_mappings(spark, d):
    return registry.version_numbers(mappings(spark, d), ["bank_id", "schema_hash", "version"], "event_id")


@query("mapping_versions", sql("SELECT bank_id, schema_hash, version, event_id, mini_version FROM mini", map=_MAP, mini=_MINI))
def mapping_versions(spark, d):
    return _numbered_mappings(spark, d).select("bank_id", "schema_hash", "version", "event_id", "mini_version")


@query("latest_mapping", sql("SELECT bank_id, schema_hash, version, mini_version, event_id FROM latest_map", map=_MAP, mini=_MINI, latest_map=_LATEST_MAP))
def latest_mapping(spark, d):
    return registry.latest(_numbered_mappings(spark, d), ["bank_id", "schema_hash"], [F.col("version"), F.col("mini_version")],
                           ["version", "mini_version", "event_id"])


@query("artifact_reuse", sql("""SELECT c_custkey AS upload_id, version, mini_version, version IS NOT NULL AS reused FROM customer LEFT JOIN latest_map
  ON bank_id = 'bank-' || (c_custkey % 60) AND schema_hash = (['view','click','signup','other'])[c_custkey % 4 + 1]""", map=_MAP, mini=_MINI, latest_map=_LATEST_MAP))
def artifact_reuse(spark, d):
    key = F.col("c_custkey")
    asked = table(spark, d, "customer").select(
        key.alias("upload_id"), F.concat(F.lit("bank-"), key % 60).alias("bank_id"),
        F.get(F.array(F.lit("view"), F.lit("click"), F.lit("signup"), F.lit("other")), (key % 4).cast("int")).alias("schema_hash"))
    return registry.reuse(asked, latest_mapping(spark, d), ["bank_id", "schema_hash"]).select("upload_id", "version", "mini_version", "reused")


# --- uploads, jobs, runs -------------------------------------------------------------------------------------------------


def uploads(spark, d):
    key = F.col("o_orderkey")
    state = F.get(F.array(F.lit("ingesting"), F.lit("uploaded"), F.lit("failed")), (key % 3).cast("int"))
    return table(spark, d, "orders").select(
        key.alias("upload_id"), F.concat(F.lit("bank-"), F.col("o_custkey")).alias("data_source_id"), state.alias("status"),
        F.md5(key.cast("string")).alias("checksum"), (key * 13 % 5000).alias("size"))


_UPL = """SELECT o_orderkey AS upload_id, 'bank-' || o_custkey AS data_source_id, (['ingesting','uploaded','failed'])[o_orderkey % 3 + 1] AS status,
  md5(CAST(o_orderkey AS VARCHAR)) AS checksum, o_orderkey * 13 % 5000 AS size FROM orders"""


@query("upload_lookup", sql("""SELECT e.event_id, u.data_source_id FROM events e JOIN upl u ON u.upload_id = e.event_id * 2 WHERE u.status = 'ingesting'""", upl=_UPL))
def upload_lookup(spark, d):
    """Metadata of uploads named by messages, only those being ingested; Spark picks broadcast or shuffle by size."""
    named = table(spark, d, "events").select("event_id", (F.col("event_id") * 2).alias("upload_id"))
    return named.join(uploads(spark, d).filter("status = 'ingesting'"), "upload_id").select("event_id", "data_source_id")


@query("checksum_compare", sql("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN b IS NULL THEN 'copy_failed' WHEN s IS NULL THEN 'file_not_found' WHEN sum_s <> sum_b OR size_s <> size_b THEN 'verification_failed' ELSE 'success' END AS outcome
  FROM (SELECT upload_id AS s, checksum AS sum_s, size AS size_s FROM upl WHERE upload_id % 17 <> 0)
  FULL JOIN (SELECT upload_id AS b, CASE WHEN upload_id % 23 = 0 THEN 'x' ELSE checksum END AS sum_b, size + CASE WHEN upload_id % 29 = 0 THEN 1 ELSE 0 END AS size_b FROM upl WHERE upload_id % 19 <> 0) ON s = b) GROUP BY 1""", upl=_UPL))
def checksum_compare(spark, d):
    """Source and copied files by path key; every file ends in exactly one outcome."""
    key = F.col("upload_id")
    source = uploads(spark, d).filter(key % 17 != 0).select(key, "checksum", "size")
    copy = uploads(spark, d).filter(key % 19 != 0).select(
        key, F.when(key % 23 == 0, F.lit("x")).otherwise(F.col("checksum")).alias("checksum"), (F.col("size") + F.when(key % 29 == 0, 1).otherwise(0)).alias("size"))
    return verified(source, copy, "upload_id").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def verified(source, copy, key):
    """Full outer comparison of two inventories (key, checksum, size)."""
    s, c = source.alias("s"), copy.alias("c")
    outcome = case([
        (F.col(f"c.{key}").isNull(), "copy_failed"), (F.col(f"s.{key}").isNull(), "file_not_found"),
        ((F.col("s.checksum") != F.col("c.checksum")) | (F.col("s.size") != F.col("c.size")), "verification_failed")], "success")
    return s.join(c, F.col(f"s.{key}") == F.col(f"c.{key}"), "full").select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"c.{key}")).alias(key), outcome.alias("outcome"))


@query("dedup_messages", """SELECT event_id - event_id % 3 AS message_id, event_type, min(event_id) AS event_id FROM events
WHERE (event_id - event_id % 3) % 2 = 1 OR event_type <> 'view' GROUP BY 1, 2""")
def dedup_messages(spark, d):
    """One row per (message, system), without those already processed."""
    ev = F.col("event_id")
    incoming = table(spark, d, "events").select((ev - ev % 3).alias("message_id"), "event_type", "event_id")
    processed = incoming.filter("message_id % 2 = 0 and event_type = 'view'").select("message_id", "event_type").distinct()
    fresh = incoming.join(processed, ["message_id", "event_type"], "left_anti")
    return fresh.groupBy("message_id", "event_type").agg(F.min("event_id").alias("event_id"))


def job_rows(spark, d):
    """Result and error rows of batch jobs; some jobs are still open."""
    key = F.col("o_orderkey")
    job = F.col("o_custkey") % 97
    return table(spark, d, "orders").select(
        F.concat(F.lit("job-"), job).alias("job_id"), key.alias("row"), F.when(job % 5 == 0, F.lit(10 ** 9)).otherwise(1).cast("long").alias("total"),
        F.when(key % 11 == 0, F.lit("error")).otherwise("ok").alias("outcome"))


_JOBS = """SELECT 'job-' || (o_custkey % 97) AS job_id, max(CASE WHEN o_custkey % 97 % 5 = 0 THEN 1000000000 ELSE 1 END)::BIGINT AS total, count(*) FILTER (o_orderkey % 11 <> 0) AS completed,
  count(*) FILTER (o_orderkey % 11 = 0) AS failed FROM orders GROUP BY 1"""


@query("batch_progress", sql("SELECT *, CASE WHEN completed + failed >= total THEN 'complete' ELSE 'in_progress' END AS status FROM jobs", jobs=_JOBS))
def batch_progress(spark, d):
    return batches.job_progress(job_rows(spark, d))


@query("batch_results", "SELECT 'job-' || (o_custkey % 97) AS job_id, CASE WHEN o_orderkey % 11 = 0 THEN 'error' ELSE 'ok' END AS outcome, count(*) AS n FROM orders GROUP BY 1, 2")
def batch_results(spark, d):
    """Result lines as JSON files per job, read back; appended, never rewritten."""
    path = scratch.folder(spark, "batch-results")
    job_rows(spark, d).write.partitionBy("job_id").json(path)
    back = spark.read.schema("row long, total long, outcome string, job_id string").json(path)
    return back.groupBy("job_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


def training_results(spark, d):
    key = F.col("o_orderkey")
    kind = F.get(F.array(*[F.lit(m) for m in catalog.MODELS]), (key % 4).cast("int"))
    return table(spark, d, "orders").select(
        F.concat(F.lit("run-"), F.floor(key / 4)).alias("training_id"), kind.alias("model_type"),
        F.when((key % 9 == 0) | (F.floor(key / 4) % 13 == 0), F.lit("FAILED")).otherwise("SUCCESS").alias("status"), (F.col("o_totalprice") / 1000).alias("duration_seconds"))


_TR = """SELECT 'run-' || (o_orderkey // 4) AS training_id, (['credit_risk','fraud_detection','loan_amount','income_verification'])[o_orderkey % 4 + 1] AS model_type,
  CASE WHEN o_orderkey % 9 = 0 OR (o_orderkey // 4) % 13 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, o_totalprice / 1000 AS duration_seconds FROM orders"""


@query("training_run_status", sql("""SELECT training_id, count(*) AS models, count(*) FILTER (status = 'SUCCESS') AS succeeded, round(sum(duration_seconds), 6) AS total_duration,
  CASE WHEN count(*) FILTER (status <> 'SUCCESS') = 0 THEN 'COMPLETE' WHEN count(*) FILTER (status = 'SUCCESS') > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS run_status FROM tr GROUP BY 1""", tr=_TR))
def training_run_status(spark, d):
    return batches.training_run(training_results(spark, d))


@query("training_completion", sql("""SELECT training_id, string_agg(CASE WHEN reported = 0 THEN model_type END, ',' ORDER BY model_type) AS waiting_for, bool_and(reported > 0) AS complete FROM (
  SELECT r.training_id, m.model_type, count(t.model_type) AS reported FROM (SELECT DISTINCT training_id FROM tr) r CROSS JOIN (VALUES ('credit_risk'), ('fraud_detection'), ('loan_amount'), ('income_verification')) m(model_type)
  LEFT JOIN (SELECT * FROM tr WHERE duration_seconds > 50) t ON t.training_id = r.training_id AND t.model_type = m.model_type GROUP BY 1, 2) GROUP BY 1""", tr=_TR))
def training_completion(spark, d):
    """Expected against reported models per run; a run waits until all have reported."""
    expected = F.array(*[F.lit(m) for m in sorted(catalog.MODELS)])
    rows = training_results(spark, d).groupBy("training_id").agg(
        F.collect_set(F.when(F.col("duration_seconds") > 50, F.col("model_type"))).alias("reported"))  # at most four values
    missing = F.array_except(expected, "reported")
    return rows.select("training_id", F.when(F.size(missing) > 0, F.array_join(missing, ",")).alias("waiting_for"),
                       (F.size(missing) == 0).alias("complete"))


@query("ops_rollup", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 4) AS error_rate, count(*) FILTER (event_type = 'purchase') AS approvals, count(DISTINCT user_id) AS applicants,
  round(quantile_cont(round(value), 0.5), 4) AS p50, round(quantile_cont(round(value), 0.95), 4) AS p95 FROM events GROUP BY 1""")
def ops_rollup(spark, d):
    """Daily requests, errors and latency.

    Latency is in whole milliseconds, so exact percentiles keep one counter per distinct value.
    """
    latency = F.round("value")
    return table(spark, d, "events").groupBy(F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.round(F.count_if(F.col("event_type") == "error") / F.count(F.lit(1)), 4).alias("error_rate"),
        F.count_if(F.col("event_type") == "purchase").alias("approvals"), F.count_distinct("user_id").alias("applicants"),
        F.round(F.percentile(latency, 0.5), 4).alias("p50"), F.round(F.percentile(latency, 0.95), 4).alias("p95"))


# --- explanation context ---------------------------------------------------------------------------------------


def _has(name):
    return "(" + " OR ".join(f"contains(q, '{w}')" for w in context.ABOUT[name]) + ")"


@query("explain_context", sql(f"""SELECT q.conv_id, turn, wants_decision, wants_training, wants_drift, a.decision, a.audit_id, t.training, c.champions,
  concat_ws(' ', CASE WHEN wants_decision AND request_id IS NULL THEN '{context.NOTES['decision']}' END, CASE WHEN wants_training AND training_id IS NULL THEN '{context.NOTES['training']}' END,
    CASE WHEN wants_drift THEN '{context.NOTES['drift']}' END) AS notes
FROM asked q LEFT JOIN LATERAL (SELECT event_id AS audit_id, {dq._LABEL_SQL.format('event_id % 5')} AS decision FROM events e WHERE e.event_type = 'purchase' AND 'REQ-' || e.user_id = q.request_id
    AND CAST(e.ts AS DATE) BETWEEN q.asked_on - 30 AND q.asked_on ORDER BY CAST(ts AS DATE) DESC, event_id DESC LIMIT 1) a ON true
  LEFT JOIN runs t USING (training_id), champions c""",
    asked=f"""SELECT conv_id, turn, request_id, training_id, asked_on, request_id IS NOT NULL OR {_has('decision')} AS wants_decision, training_id IS NOT NULL OR {_has('training')} AS wants_training,
  {_has('drift')} AS wants_drift FROM (SELECT conv_id, turn, lower(text) AS q, CASE WHEN conv_id % 3 = 0 THEN 'REQ-' || conv_id END AS request_id,
    CASE WHEN conv_id % 5 = 0 THEN 'run-' || conv_id END AS training_id, DATE '2024-01-05' + CAST(conv_id % 40 AS INTEGER) AS asked_on FROM conversations WHERE role = 'user')""",
    tr=_TR, runs="""SELECT training_id, '{' || string_agg('"' || model_type || '":"' || status || '"', ',' ORDER BY model_type) || '}' AS training FROM (SELECT DISTINCT training_id, model_type, status FROM tr) GROUP BY 1""",
    mv=_MV, champions="""SELECT '{' || string_agg('"' || m || '":"' || coalesce(CAST(version AS VARCHAR), 'NOT_REGISTERED') || '"', ',' ORDER BY m) || '}' AS champions
  FROM (VALUES ('credit_risk'), ('fraud_detection'), ('loan_amount'), ('income_verification')) t(m) LEFT JOIN (SELECT model_type, max(version) AS version FROM mv GROUP BY 1) ON m = model_type"""))
def explain_context(spark, d):
    """Whole questions with the audited decision, the training run and the champions they need, and notes on what they lack."""
    conv = F.col("conv_id")
    questions = table(spark, d, "conversations").filter("role = 'user'").select(
        "conv_id", "turn", "text", F.when(conv % 3 == 0, F.concat(F.lit("REQ-"), conv)).alias("request_id"), F.when(conv % 5 == 0, F.concat(F.lit("run-"), conv)).alias("training_id"),
        F.date_add(F.lit("2024-01-05").cast("date"), (conv % 40).cast("int")).alias("asked_on"))
    known = context.explain(questions, dq.decisions_log(spark, d), training_results(spark, d), registry.champion_snapshot(spark, _latest_models(spark, d)))
    return known.select("conv_id", "turn", "wants_decision", "wants_training", "wants_drift", "decision", "audit_id", "training", "champions", "notes")
