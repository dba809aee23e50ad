"""Feature selection by fitted importance and hyper-parameter search by successive halving.

A search draws candidates from ranges with a fixed seed. All of them are fitted on a small share of the training rows, the better
half on twice as many, and so on to all rows; every score comes from the same validation rows. Shares are nested and picked by hash,
so a run can be repeated row for row. The trials of one round are independent Spark jobs and run side by side.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.operators import metrics

#: Range of each parameter: lowest, highest, and whether it is drawn on a logarithmic scale. Whole numbers stay whole.
Space = dict[str, tuple[float, float, bool]]
LOAN: Space = {"maxIter": (5, 15, False), "maxDepth": (2, 5, False), "stepSize": (0.03, 0.3, True), "subsamplingRate": (0.7, 0.9, False), "minInstancesPerNode": (1, 20, True)}
INCOME: Space = {"numTrees": (8, 24, False), "maxDepth": (3, 7, False), "subsamplingRate": (0.7, 0.9, False), "minInstancesPerNode": (1, 20, True)}


def importance(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    """feature, importance, rank, share, selected of a fitted tree model; ``names`` are in the order of its vector."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    return metrics.cumulative_share(spark.createDataFrame(rows, "feature string, importance double"))


def select_features(train: DataFrame, classes: bool, names: list[str] = catalog.FEATURES, seed: int = 42) -> DataFrame:
    """Importance of all features in a first forest, with ``selected`` for the fewest that hold 95 % of it; needs ``features`` and ``label``."""
    kind = RandomForestClassifier if classes else RandomForestRegressor
    forest = kind(featuresCol="features", labelCol="label", numTrees=20, maxDepth=5, seed=seed).fit(train)
    return importance(train.sparkSession, forest, names)


def with_selected(data: DataFrame, names: list[str]) -> DataFrame:
    """``features`` anew from the selected columns only."""
    filled = data.drop("features").withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})
    return VectorAssembler(inputCols=names, outputCol="features").transform(filled)


def draw(space: Space, trials: int, seed: int = 42) -> list[dict[str, float]]:
    rng = random.Random(seed)

    def one(low, high, logarithmic):
        value = math.exp(rng.uniform(math.log(low), math.log(high))) if logarithmic else rng.uniform(low, high)
        return round(value) if isinstance(low, int) and isinstance(high, int) else value

    return [{name: one(*limits) for name, limits in space.items()} for _ in range(trials)]


def rung(data: DataFrame, share: float, key: str = "request_id") -> DataFrame:
    """A share of the rows by hash; a larger share holds all rows of a smaller one."""
    return data if share >= 1 else data.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))


def halving(train: DataFrame, candidates: list[dict], fit: Callable[[DataFrame, dict], Model], score: Callable[[Model], float], larger: bool,
            parallelism: int = 4) -> tuple[list[tuple], dict]:
    """(log rows of trial, rung, share, params, value and whether it goes on; the best parameters)."""
    rounds = max(1, math.ceil(math.log2(len(candidates))))
    left, log = list(range(len(candidates))), []
    for r in range(rounds):
        share = 0.5 ** (rounds - 1 - r)
        rows = rung(train, share).persist()
        with ThreadPool(min(parallelism, len(left))) as pool:
            values = pool.map(inheritable_thread_target(train.sparkSession)(lambda i: score(fit(rows, candidates[i]))), left)
        rows.unpersist()
        order = sorted(range(len(left)), key=lambda k: ((-values[k] if larger else values[k]), left[k]))
        on = {left[k] for k in order[: max(1, len(left) // 2) if r < rounds - 1 else 1]}
        log += [(i, r, share, json.dumps(candidates[i], sort_keys=True), float(v), i in on) for i, v in zip(left, values, strict=True)]
        left = [i for i in left if i in on]
    return log, candidates[left[0]]


LOG = "trial int, rung int, share double, params string, value double, kept boolean"


def tune_loan(train: DataFrame, validation: DataFrame, trials: int = 8, seed: int = 42) -> tuple[list[tuple], Model]:
    """Boosted regression trees by validation RMSE; the best parameters are fitted again on both parts."""
    def learner(params):
        return GBTRegressor(featuresCol="features", labelCol="label", seed=seed, **params)

    judge = RegressionEvaluator(labelCol="label", metricName="rmse")
    validation = validation.persist()
    log, best = halving(train, draw(LOAN, trials, seed), lambda rows, p: learner(p).fit(rows), lambda m: judge.evaluate(m.transform(validation)), larger=False)
    model = Pipeline(stages=[learner(best)]).fit(train.unionByName(validation))
    validation.unpersist()
    return log, model


def tune_income(train: DataFrame, validation: DataFrame, trials: int = 8, seed: int = 42) -> tuple[list[tuple], Model]:
    """Forest of income tiers by weighted F1 on the validation rows."""
    def learner(params):
        return RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed, **params)

    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    validation = validation.persist()
    log, best = halving(train, draw(INCOME, trials, seed), lambda rows, p: learner(p).fit(rows), lambda m: judge.evaluate(m.transform(validation)), larger=True)
    model = Pipeline(stages=[learner(best)]).fit(train.unionByName(validation))
    validation.unpersist()
    return log, model
