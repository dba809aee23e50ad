"""Default risk, loan amount and income models with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import decision
from bureaulake.operators import ranking


def with_vector(rows: DataFrame) -> DataFrame:
    """Adds ``features``; a missing weight counts as 0, as it does in the score."""
    filled = rows.withColumns({f: F.coalesce(f, F.lit(0.0)) for f in catalog.FEATURES})
    return VectorAssembler(inputCols=catalog.FEATURES, outputCol="features").transform(filled)


def labelled(rows: DataFrame, label: str, stratify: bool = True) -> DataFrame:
    """Rows with a label, their vector and a reproducible 70/15/15 ``split``."""
    known = with_vector(rows.filter(F.col(label).isNotNull())).withColumn("label", F.col(label).cast("double"))
    return ranking.split_labels(known, ["label"] if stratify else [], F.md5("request_id"))


def part(data: DataFrame, name: str) -> DataFrame:
    return data.filter(F.col("split") == name)


def class_weight(data: DataFrame) -> DataFrame:
    """Positives weighted by negatives per positive, so both classes weigh the same."""
    counts = data.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    weight = counts["n"] / counts["p"] if counts["p"] else 1.0
    return data.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(1.0))


def fit_risk(train: DataFrame, trees: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42) -> PipelineModel:
    booster = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth,
                            stepSize=step, seed=seed)
    return Pipeline(stages=[booster]).fit(class_weight(train))


def tune_risk(train_and_validation: DataFrame, depths=(2, 4), steps=(0.1, 0.3), trees: int = 10, parallelism: int = 4):
    """Grid by validation AUC; the candidates are fitted in parallel."""
    booster = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, seed=42)
    grid = ParamGridBuilder().addGrid(booster.maxDepth, list(depths)).addGrid(booster.stepSize, list(steps)).build()
    search = TrainValidationSplit(
        estimator=booster, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="label"),
        trainRatio=0.82, parallelism=parallelism, seed=42)
    fitted = search.fit(class_weight(train_and_validation))
    return grid, fitted.validationMetrics, fitted.bestModel


def raw_probability(model: PipelineModel, data: DataFrame) -> DataFrame:
    return model.transform(data).withColumn("score", vector_to_array("probability")[1])


def calibrate(scored_holdout: DataFrame) -> tuple[float, float]:
    """Platt parameters (a, b) from a one-variable logistic fit on held-out scores."""
    one = scored_holdout.select("label", array_to_vector(F.array("score")).alias("x"))
    fitted = LogisticRegression(featuresCol="x", labelCol="label", maxIter=50).fit(one)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def score_risk(model: PipelineModel, a: float, b: float, data: DataFrame) -> DataFrame:
    p = decision.platt(F.col("score"), a, b)
    return raw_probability(model, data).withColumns({"probability_of_default": p, "pd_confidence": decision.confidence(p)})


def fit_surrogate(train: DataFrame) -> tuple[list[float], list[float]]:
    """(coefficients, feature means) of an additive model used for explanations."""
    fitted = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=0.01, maxIter=50).fit(class_weight(train))
    means = train.agg(*[F.avg(f).alias(f) for f in catalog.FEATURES]).first()
    return [float(c) for c in fitted.coefficients], [float(means[f]) for f in catalog.FEATURES]


def contributions(coefficients: list[float], means: list[float]) -> Column:
    """Array of (feature, value): how far each feature moves the log-odds from an average applicant."""
    return F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.lit(c) * (F.col(f) - F.lit(m))).alias("value"))
        for f, c, m in zip(catalog.FEATURES, coefficients, means)])


def fit_loan(train: DataFrame, trees: int = 20, seed: int = 42) -> PipelineModel:
    """Three regressors on the clipped target; :func:`loan_amount` is their clipped mean."""
    common = dict(labelCol="label", featuresCol="features")
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        GBTRegressor(**common, maxIter=trees, maxDepth=4, stepSize=0.1, seed=seed, predictionCol="boosted"),
        RandomForestRegressor(**common, numTrees=trees, maxDepth=6, seed=seed, predictionCol="forest"),
        LinearRegression(labelCol="label", featuresCol="scaled", regParam=1.0, predictionCol="linear"),
    ]).fit(train)


def clipped_target(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, decision.clamp_loan(F.col(column)))


def loan_amount() -> Column:
    return decision.clamp_loan((F.col("boosted") + F.col("forest") + F.col("linear")) / 3)


def fit_income(train: DataFrame, trees: int = 30, seed: int = 42) -> PipelineModel:
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=6, seed=seed)
    return Pipeline(stages=[forest]).fit(train)
