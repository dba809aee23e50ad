"""Queries: training, tuning, calibration, scoring, explanation and storage of models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import decision as dec
from bureaulake.functions.bins import case
from bureaulake.ml import forest, log, models, search
from bureaulake.operators import metrics, registry
from bureaulake.plans import facts
from bureaulake.queries.decision_queries import flagged, reason_codes, top_five
from bureaulake.queries.ctes import sql
from bureaulake.queries.scoring_queries import _INCOME, training_rows
from bureaulake.sources import scratch

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def contract(name, oracle, check):
    """Registers what SQL can state about a model's output: which rows there are, and whether their values are possible and agree with
    each other. The function itself keeps the whole output."""
    def register(fn):
        def run(spark, d):
            return check(fn(spark, d))

        QUERIES[name], ORACLE[name] = run, oracle
        return fn
    return register


def _within(column, low, high):
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


_EVERY = "SELECT request_id, true AS possible, true AS labelled FROM income"


#: Rows of a stored file: learners pass over these tables many times, in no more tasks than there are files.
_FILE_ROWS = 20_000


def training_table(spark, d):
    """Training rows written once; every pass of a learner reads this table instead of the raw bureau data."""
    path = scratch.folder(spark, "training")
    training_rows(spark, d).select("request_id", *catalog.FEATURES, "default_flag", "max_successful_loan_ghs", "income_tier").write.option("maxRecordsPerFile", _FILE_ROWS).parquet(path)
    return spark.read.parquet(path)


def _stored(df, name):
    path = scratch.folder(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", _FILE_ROWS).parquet(path)
    return df.sparkSession.read.parquet(path)


def _risk_data(spark, d):
    return _stored(models.labelled(training_table(spark, d), "default_flag"), "risk-data")


def _long(one_row, names):
    return one_row.unpivot([], names, "metric", "value")


@contract("risk_train", """SELECT 'credit_risk' AS model_type, metric, true AS possible, true AS as_limits FROM (VALUES ('auc'), ('f1'), ('precision'), ('recall'), ('log_loss')) v(metric)""",
          lambda rows: rows.select("model_type", "metric", _within("value", 0, F.when(F.col("metric") == "log_loss", 100.0).otherwise(1.0)).alias("possible"),
                                   (F.col("passed") == F.when(F.col("metric") == "log_loss", F.col("value") <= 0.5).otherwise(F.col("value") >= case(
                                       [(F.col("metric") == "auc", 0.78), (F.col("metric") == "f1", 0.75), (F.col("metric") == "precision", 0.70)], 0.65))).alias("as_limits")))
def risk_train(spark, d):
    """Holdout metrics of the default-risk model with the acceptance gate."""
    data = _risk_data(spark, d)
    model = models.fit_risk(models.part(data, "train"))
    scored = models.raw_probability(model, models.part(data, "holdout")).select(F.col("label").cast("int").alias("label"), "score")
    names = ["auc", "f1", "precision", "recall", "log_loss"]
    found = _long(metrics.binary(scored).select(*names), names).withColumn("model_type", F.lit("credit_risk"))
    limits = spark.createDataFrame(metrics.LIMITS, "model_type string, metric string, low double, high double")
    return metrics.gate(found, limits)


@contract("risk_tune", "SELECT CAST(d AS INTEGER) AS max_depth, CAST(s AS DOUBLE) AS step_size, true AS possible FROM (VALUES (2), (4)) x(d), (VALUES (0.1), (0.3)) y(s)",
          lambda rows: rows.select("max_depth", "step_size", _within("auc", 0, 1).alias("possible")))
def risk_tune(spark, d):
    data = _risk_data(spark, d)
    grid, found, _ = models.tune_risk(data.filter("split <> 'holdout'"))
    rows = [({p.name: v for p, v in params.items()}, auc) for params, auc in zip(grid, found)]
    return spark.createDataFrame([(int(p["maxDepth"]), float(p["stepSize"]), float(a)) for p, a in rows], "max_depth int, step_size double, auc double")


@contract("risk_calibrate", "SELECT true AS finite, true AS possible",
          lambda rows: rows.select((~F.isnan("a") & ~F.isnan("b") & _within("a", -1e6, 1e6)).alias("finite"), (_within("raw_loss", 0, 100) & _within("calibrated_loss", 0, 100)).alias("possible")))
def risk_calibrate(spark, d):
    """Platt parameters and log-loss before and after calibration on the holdout."""
    data = _risk_data(spark, d)
    model = models.fit_risk(models.part(data, "train"))
    held = models.raw_probability(model, models.part(data, "holdout"))
    a, b = models.calibrate(held)
    rows = held.select("label", "score", dec.platt(F.col("score"), a, b).alias("calibrated"))

    def loss(p):
        p = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
        return F.avg(-F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(F.lit(1.0) - p)))

    return rows.agg(F.lit(a).alias("a"), F.lit(b).alias("b"), loss(F.col("score")).alias("raw_loss"), loss(F.col("calibrated")).alias("calibrated_loss"))


@contract("risk_score", sql(_EVERY, income=_INCOME), lambda rows: rows.select(
    "request_id", (_within("probability_of_default", 0, 1) & _within("pd_confidence", 0.5, 1)).alias("possible"), (F.col("risk_tier") == dec.pd_tier(F.col("probability_of_default"))).alias("labelled")))
def risk_score(spark, d):
    """Calibrated default probability and tier of every applicant, labelled or not."""
    table = training_table(spark, d)
    data = models.labelled(table, "default_flag")
    model = models.fit_risk(models.part(data, "train"))
    a, b = models.calibrate(models.raw_probability(model, models.part(data, "holdout")))
    scored = models.score_risk(model, a, b, models.with_vector(table))
    return scored.select("request_id", "probability_of_default", "pd_confidence", dec.pd_tier(F.col("probability_of_default")).alias("risk_tier"))


@contract("risk_explain", sql(_EVERY, income=_INCOME), lambda rows: rows.select(
    "request_id", F.forall(F.split("top_features", ","), lambda f: f.isin(catalog.FEATURES)).alias("possible"),
    ((F.size(F.split("top_features", ",")) == 5) & (F.size(F.split("top_values", ",")) == 5) & F.col("reason_codes").isNotNull()).alias("labelled")))
def risk_explain(spark, d):
    """Top five contributions and reason codes of every applicant."""
    table = training_table(spark, d)
    data = models.labelled(table, "default_flag")
    coefficients, means = models.fit_surrogate(models.part(data, "train"))
    filled = models.with_vector(table).withColumn("top", top_five(models.contributions(coefficients, means)))
    return filled.select(
        "request_id", F.array_join(F.transform("top", lambda t: t["feature"]), ",").alias("top_features"),
        F.array_join(F.transform("top", lambda t: F.round(t["value"], 4).cast("string")), ",").alias("top_values"),
        F.array_join(reason_codes(F.col("top")), ",").alias("reason_codes"))


def _forest(spark, d, trees=200):
    vectors = _stored(facts.feature_table(spark, d).select("request_id", *catalog.FEATURES), "vectors")
    nodes = _stored(forest.fit(vectors, trees=trees), "forest")
    return vectors, nodes


@contract("fraud_train", "SELECT CAST(t AS INTEGER) AS tree, true AS grown, true AS sampled FROM range(0, 200) r(t)", lambda rows: rows.select(
    "tree", (F.col("nodes") == 2 * F.col("leaves") - 1).alias("grown"), F.col("rows").between(1, 256).alias("sampled")))
def fraud_train(spark, d):
    """Size and depth facts of each tree of the isolation forest."""
    _, nodes = _forest(spark, d)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"), F.count_if(leaf).alias("leaves"),
                                     F.sum(F.when(leaf, F.col("size"))).alias("rows"))


@contract("fraud_score", sql(_EVERY, income=_INCOME), lambda rows: rows.select(
    "request_id", _within("fraud_anomaly_score", 0, 1).alias("possible"), F.col("fraud_risk_flag").isin("LOW", "MEDIUM", "HIGH").alias("labelled")))
def fraud_score(spark, d):
    """Anomaly score and flag of every applicant with thresholds at the 1st and 5th percentile."""
    vectors, nodes = _forest(spark, d)
    return flagged(_stored(forest.score(vectors, nodes), "anomaly"))


def _loan(spark, d):
    # Order prices are far above the loan range; a fiftieth lies inside it.
    table = training_table(spark, d).withColumn("max_successful_loan_ghs", F.col("max_successful_loan_ghs") / 50)
    data = models.labelled(models.clipped_target(table.filter("max_successful_loan_ghs is not null"), "max_successful_loan_ghs"),
                           "max_successful_loan_ghs", stratify=False)
    data = _stored(data, "loan-data")
    return table, data, models.fit_loan(models.part(data, "train"))


@contract("loan_train", "SELECT model, true AS possible FROM (VALUES ('boosted'), ('forest'), ('linear'), ('ensemble')) v(model)", lambda rows: rows.select(
    "model", (_within("mae", 0, F.col("rmse") + 1e-9) & (F.col("rmse") <= 1e6) & F.coalesce(F.col("r2") <= 1, F.lit(True))).alias("possible")))
def loan_train(spark, d):
    """Holdout errors of the three members and their mean."""
    _, data, model = _loan(spark, d)
    scored = model.transform(models.part(data, "holdout")).withColumns({"actual": F.col("label"), "ensemble": models.loan_amount()})
    out = None
    for name in ("boosted", "forest", "linear", "ensemble"):
        row = metrics.regression(scored, name)
        out = row if out is None else out.unionByName(row)
    return out


@contract("loan_score", sql(_EVERY, income=_INCOME), lambda rows: rows.select(
    "request_id", _within("recommended_loan_amount", catalog.LOAN_FLOOR, catalog.LOAN_CEILING).alias("possible"),
    (F.col("loan_tier") == dec.loan_tier(F.col("recommended_loan_amount"))).alias("labelled")))
def loan_score(spark, d):
    table, _, model = _loan(spark, d)
    scored = model.transform(models.with_vector(table)).withColumn("recommended_loan_amount", models.loan_amount())
    return scored.select("request_id", "recommended_loan_amount", dec.loan_tier(F.col("recommended_loan_amount")).alias("loan_tier"))


def _income(spark, d):
    table = training_table(spark, d)
    data = _stored(models.labelled(table, "income_tier"), "income-data")
    return table, data, models.fit_income(models.part(data, "train"))


@contract("income_train", "SELECT CAST(c AS INTEGER) AS class, true AS possible FROM range(0, 4) r(c)", lambda rows: rows.select(
    F.col("class").cast("int").alias("class"), (_within("precision", 0, 1) & _within("recall", 0, 1) & _within("f1", 0, 1) & (F.col("tp") <= F.col("support"))).alias("possible")))
def income_train(spark, d):
    """Per-class holdout metrics of the income model."""
    _, data, model = _income(spark, d)
    scored = model.transform(models.part(data, "holdout"))
    return metrics.per_class(scored.select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("predicted")), 4)


@contract("income_score", sql(_EVERY, income=_INCOME), lambda rows: rows.select(
    "request_id", (_within("income_tier", 0, 3) & _within("income_confidence", 0.25, 1)).alias("possible"), (F.col("income_tier_label") == dec.income_label(F.col("income_tier"))).alias("labelled")))
def income_score(spark, d):
    table, _, model = _income(spark, d)
    scored = model.transform(models.with_vector(table))
    tier, confidence = dec.best_class(models.vector_to_array("probability"))
    return scored.select("request_id", tier.alias("income_tier"), dec.income_label(tier).alias("income_tier_label"), confidence.alias("income_confidence"))


@contract("model_roundtrip", "SELECT true AS scored, true AS same, true AS promote", lambda rows: rows.select(
    (F.col("rows") > 0).alias("scored"), (F.col("equal") == F.col("rows")).alias("same"), "promote"))
def model_roundtrip(spark, d):
    """A stored champion scores exactly like the fitted one; its version row goes through the champion gate."""
    data = _risk_data(spark, d)
    model = models.fit_risk(models.part(data, "train"), trees=5)
    path = scratch.folder(spark, "model")
    model.save(path)
    loaded = PipelineModel.load(path)
    held = models.part(data, "holdout")
    before = models.raw_probability(model, held).select("request_id", F.col("score").alias("before"))
    after = models.raw_probability(loaded, held).select("request_id", F.col("score").alias("after"))
    same = before.join(after, "request_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") == F.col("after")).alias("equal"))
    versions = same.select(F.lit("credit_risk").alias("model_type"), F.lit("1").alias("version"), (F.col("equal") / F.col("rows")).alias("metric"))
    gate = registry.champion_gate(versions.select("model_type", "metric"), versions)
    return same.crossJoin(F.broadcast(gate.select("promote")))  # one row each


# --- selection, search and the model log ---------------------------------------------------------------------------


def _loan_data(spark, d):
    table = training_table(spark, d).withColumn("max_successful_loan_ghs", F.col("max_successful_loan_ghs") / 50)
    known = models.clipped_target(table.filter("max_successful_loan_ghs is not null"), "max_successful_loan_ghs")
    return _stored(models.labelled(known, "max_successful_loan_ghs", stratify=False), "loan-data")


def _selected(data, classes):
    """The training data with only the features that hold 95 % of the importance, and the importance table."""
    found = search.select_features(models.part(data, "train"), classes)
    names = [r["feature"] for r in found.filter("selected").orderBy("rank").collect()]  # at most thirty
    return _stored(search.with_selected(data, names), "selected"), found


@query("feature_selection", f"""SELECT m AS model_type, {len(catalog.FEATURES)}::BIGINT AS features, 1e0 AS total, true AS enough, true AS fewest, true AS fed_back
FROM (VALUES ('loan_amount'), ('income_verification')) v(m)""")
def feature_selection(spark, d):
    """Importance of fitted forests per model: all features, the fewest with 95 % of it, and whether the next fit sees just these."""
    out = None
    income = _stored(models.labelled(training_table(spark, d), "income_tier"), "income-data")
    for kind, data, classes in (("loan_amount", _loan_data(spark, d), False), ("income_verification", income, True)):
        chosen, found = _selected(data, classes)
        width = chosen.select(F.size(models.vector_to_array("features")).alias("w")).agg(F.min("w").alias("low"), F.max("w").alias("high"))
        last = F.max(F.when(F.col("selected"), F.col("share")))
        before = F.max(F.when(F.col("selected") & (F.col("rank") < F.col("kept")), F.col("share")))
        kept = found.agg(F.count_if("selected").alias("kept"))
        row = found.crossJoin(F.broadcast(kept)).crossJoin(F.broadcast(width)).agg(  # one row each
            F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"), (last >= 0.95).alias("enough"),
            F.coalesce(before < 0.95, F.lit(True)).alias("fewest"), ((F.max("low") == F.max("kept")) & (F.max("high") == F.max("kept"))).alias("fed_back"))
        row = row.select(F.lit(kind).alias("model_type"), "*")
        out = row if out is None else out.unionByName(row)
    return out


_RUNGS = "SELECT rung, share, trials, kept, 'ok' AS problem FROM (VALUES (0, 0.25e0, 8::BIGINT, 4::BIGINT), (1, 0.5e0, 4::BIGINT, 2::BIGINT), (2, 1e0, 2::BIGINT, 1::BIGINT)) v(rung, share, trials, kept)"


def _rounds(spark, rows, larger, low, high):
    """The search per round: trials, how many went on, and whether these were the best and all values possible."""
    table = spark.createDataFrame(rows, search.LOG)
    value = F.col("value") if larger else -F.col("value")
    kept, out = F.min(F.when(F.col("kept"), value)), F.max(F.when(~F.col("kept"), value))
    fine = F.bool_and(F.col("value").between(low, high)) & F.coalesce(kept >= out, F.lit(True))
    return table.groupBy("rung", "share").agg(F.count(F.lit(1)).alias("trials"), F.count_if("kept").alias("kept"), F.when(fine, F.lit("ok")).otherwise("wrong").alias("problem"))


@query("loan_tune", _RUNGS)
def loan_tune(spark, d):
    """Search over the selected features by validation RMSE, half of the trials going on per round."""
    data, _ = _selected(_loan_data(spark, d), False)
    rows, _ = search.tune_loan(models.part(data, "train"), models.part(data, "validation"))
    return _rounds(spark, rows, False, 0.0, 100_000.0)


@query("income_tune", _RUNGS)
def income_tune(spark, d):
    data, _ = _selected(_stored(models.labelled(training_table(spark, d), "income_tier"), "income-data"), True)
    rows, _ = search.tune_income(models.part(data, "train"), models.part(data, "validation"))
    return _rounds(spark, rows, True, 0.0, 1.0)


@query("model_log", "SELECT * FROM (VALUES (1, 'run-1', true, true), (2, 'run-2', true, true)) v(version, run_id, as_compared, loads)")
def model_log(spark, d):
    """Two trainings and a repeated one: two versions, each promoted exactly if it is as good as its champion; stored models load."""
    data, folder = _risk_data(spark, d), scratch.folder(spark, "model-log")
    held = models.part(data, "holdout")
    for run, trees in (("run-1", 4), ("run-2", 2), ("run-1", 4)):
        model, path = models.fit_risk(models.part(data, "train"), trees=trees), scratch.folder(spark, "model")
        found = metrics.binary(models.raw_probability(model, held).select(F.col("label").cast("int").alias("label"), "score")).select("auc", "log_loss").first()
        model.save(path)
        log.append(spark, folder, "credit_risk", run, {"auc": float(found["auc"] or 0.5), "log_loss": float(found["log_loss"])}, "auc", {"trees": trees}, path)
    rows = log.read(spark, folder)
    sizes = [(r["version"], len(PipelineModel.load(r["model_path"]).stages) == 1) for r in rows.select("version", "model_path").collect()]  # one per training
    as_compared = F.col("promoted") == (F.col("champion_value").isNull() | (F.col("metric") >= F.col("champion_value")))
    return rows.join(spark.createDataFrame(sizes, "version int, loads boolean"), "version").select("version", "run_id", as_compared.alias("as_compared"), "loads")
