"""Model metrics as exact aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.functions.bins import case
from bureaulake.operators.ranking import with_value_bucket


def auc(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact rank AUC per ``keys`` from ``label`` (0/1) and ``score`` in [0, 1], ties counted half.

    Rows collapse to one per distinct score map-side.  The running count of negatives is taken inside buckets between
    split points of the scores plus a per-bucket start, so no task sorts all scores, also when they lie close together.
    """
    counts = with_value_bucket(df.groupBy(*keys, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")), keys, "score")
    keyed = [F.col(k) for k in keys] + [F.lit(0)]
    before = Window.partitionBy(*keyed).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy(*keys, "_b").agg(F.sum("neg").alias("_n")).select(
        *keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    running = counts.withColumn("_below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    below = F.col("_start") + F.col("_below")
    joined = running.join(starts, [*keys, "_b"])
    totals = joined.groupBy(*keys).agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2.0)).alias("u"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    pairs = F.col("positives") * F.col("negatives")
    return totals.select(*keys, "positives", "negatives", (F.col("u") / F.when(pairs > 0, pairs)).alias("auc"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0."""
    return F.when(whole > 0, part / F.when(whole > 0, whole)).otherwise(0.0)


def binary(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: confusion counts, precision, recall, F1, log-loss and AUC from ``label, score``."""
    predicted, actual = F.col("score") >= threshold, F.col("label") == 1
    p = F.least(F.greatest(F.col("score"), F.lit(1e-15)), F.lit(1 - 1e-15))
    base = df.agg(
        F.count_if(actual & predicted).alias("tp"), F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"), F.count_if(~actual & ~predicted).alias("tn"),
        F.avg(-F.when(actual, F.log(p)).otherwise(F.log(F.lit(1.0) - p))).alias("log_loss"))
    tp = F.col("tp")
    rated = base.withColumns({"precision": ratio(tp, tp + F.col("fp")), "recall": ratio(tp, tp + F.col("fn")),
                              "f1": ratio(2 * tp, 2 * tp + F.col("fp") + F.col("fn"))})
    return rated.crossJoin(F.broadcast(auc(df, []).select("auc")))  # one row each


def regression(df: DataFrame, prediction: str, actual: str = "actual") -> DataFrame:
    """RMSE, MAE and R2; the spread of the actual values comes from the same pass."""
    error = F.col(prediction) - F.col(actual)
    sums = df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(actual).alias("spread"))
    return sums.select(F.lit(prediction).alias("model"), F.sqrt("mse").alias("rmse"), "mae",
                       (F.lit(1.0) - F.col("mse") / F.when(F.col("spread") > 0, F.col("spread"))).alias("r2"))


def per_class(df: DataFrame, classes: int) -> DataFrame:
    """Support, precision, recall and F1 per class from ``label, predicted``."""
    c = F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("class")
    cells = df.groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n"))  # classes x classes rows
    long = cells.select("*", c)
    n = F.col("n")
    got = long.groupBy("class").agg(
        F.sum(F.when(F.col("label") == F.col("class"), n).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("predicted") == F.col("class"), n).otherwise(0)).alias("guessed"),
        F.sum(F.when((F.col("label") == F.col("class")) & (F.col("predicted") == F.col("class")), n).otherwise(0)).alias("tp"))
    return got.select("class", "support", "tp", ratio(F.col("tp"), F.col("guessed")).alias("precision"),
                      ratio(F.col("tp"), F.col("support")).alias("recall"),
                      ratio(2 * F.col("tp"), F.col("guessed") + F.col("support")).alias("f1"))


def confusion(df: DataFrame, classes: int) -> DataFrame:
    """The matrix of ``label, predicted`` as rows, also where nothing falls in a cell."""
    cells = df.groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n"))  # classes x classes rows
    every = df.sparkSession.range(classes * classes).select(F.floor(F.col("id") / classes).cast("int").alias("label"), (F.col("id") % classes).cast("int").alias("predicted"))
    return every.join(cells, ["label", "predicted"], "left").select("label", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def gate(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Metrics against limits; ``limits`` has model_type, metric, low, high (either may be null)."""
    value = F.col("value")
    ok = F.coalesce(value >= F.col("low"), F.lit(True)) & F.coalesce(value <= F.col("high"), F.lit(True))
    return metrics.join(F.broadcast(limits), ["model_type", "metric"]).select(  # a dozen limits
        "model_type", "metric", "value", ok.alias("passed"),
        case([(value < F.col("low"), "below minimum"), (value > F.col("high"), "above maximum")]).alias("problem"))


# Acceptance limits per model.
LIMITS = [
    ("credit_risk", "auc", 0.78, None), ("credit_risk", "f1", 0.75, None), ("credit_risk", "precision", 0.70, None),
    ("credit_risk", "recall", 0.65, None), ("credit_risk", "log_loss", None, 0.50),
    ("loan_amount", "rmse", None, 2500.0), ("loan_amount", "mae", None, 1500.0), ("loan_amount", "r2", 0.55, None),
    ("income_verification", "auc_ovr", 0.75, None), ("income_verification", "weighted_f1", 0.70, None),
    ("income_verification", "recall", 0.60, None), ("income_verification", "precision", 0.55, None),
]


def cumulative_share(importance: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Features in falling importance until their share reaches ``threshold``; one row per feature of a model."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")  # thirty rows
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))
    ranked = importance.withColumns({"rank": F.row_number().over(order), "share": F.sum("importance").over(upto) / total})
    return ranked.withColumn("selected", F.coalesce(F.lag("share").over(order), F.lit(0.0)) < threshold)
