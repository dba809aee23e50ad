"""Imputation parameters, the living contract and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog


def parameters(vectors: DataFrame) -> DataFrame:
    """One row, one column per imputable feature: exact median or 0; 0 when there is no value.

    The features are bin weights, so the exact median keeps a handful of distinct values in its state.
    """
    return vectors.agg(*[
        F.coalesce(F.median(f), F.lit(0.0)).alias(f) if kind == "MEDIAN" else F.lit(0.0).alias(f)
        for f, kind in catalog.IMPUTABLE.items()])


def parameter_rows(one_row: DataFrame) -> DataFrame:
    """Long form ``feature, strategy, value``."""
    names = list(catalog.IMPUTABLE)
    long = one_row.unpivot([], names, "feature", "value")
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in catalog.IMPUTABLE.items() for x in pair]), F.col("feature"))
    return long.select("feature", kind.alias("strategy"), "value")


def fill(value: Column, replacement: Column) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), replacement)


def impute(vectors: DataFrame, one_row: DataFrame) -> DataFrame:
    """Fill the imputable features from a one-row parameter table."""
    renamed = one_row.select(*[F.col(f).alias(f"_p_{f}") for f in catalog.IMPUTABLE])
    joined = vectors.crossJoin(F.broadcast(renamed))  # one row by construction
    return joined.withColumns({f: fill(F.col(f), F.col(f"_p_{f}")) for f in catalog.IMPUTABLE}).drop(*renamed.columns)


def unfilled() -> Column:
    """Features that are still null and have no rule, as an error text; null when complete."""
    names = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in catalog.REQUIRED_FEATURES]))
    return F.when(F.size(names) > 0, F.concat(F.lit("no imputation rule for: "), F.array_join(names, ",")))


def live_contract(candidates: DataFrame, previous: DataFrame, threshold: float = 0.05) -> DataFrame:
    """New median values where they moved by ``threshold`` or more; ``previous`` has feature, value."""
    old = previous.select("feature", F.col("value").alias("old_value"))
    new = candidates.filter("strategy = 'MEDIAN'").select("feature", F.col("value").alias("candidate"))
    drift = F.abs(F.col("candidate") - F.col("old_value"))
    changed = F.col("candidate").isNotNull() & (F.col("old_value").isNull() | (drift >= threshold))
    return new.join(old, "feature", "left").select(
        "feature", "old_value", F.round("candidate", 6).alias("candidate_value"), F.round(drift, 6).alias("drift_abs"),
        changed.alias("updated"),
        F.when(changed, F.round("candidate", 6)).otherwise(F.col("old_value")).alias("value"))


def effective_policy(static: DataFrame, live: DataFrame) -> DataFrame:
    """Static shape with live values on top; live features unknown to the static policy do not add rows."""
    return static.join(live.select("feature", F.col("value").alias("live_value")), "feature", "left").select(
        "feature", "strategy", F.coalesce("live_value", "value").alias("value"),
        F.when(F.col("live_value").isNotNull(), F.lit("live")).otherwise("static").alias("source"))


def training_errors(df: DataFrame) -> list[str]:
    """Schema problems of a training table; reads no rows."""
    types = dict(df.dtypes)
    targets = ["default_flag", "max_successful_loan_ghs", "income_tier"]
    missing = [f for f in catalog.FEATURES if f not in types]
    errors = [f"Missing feature columns: {missing}"] if missing else []
    gone = [t for t in targets if t not in types]
    errors += [f"Missing target columns: {gone}"] if gone else []
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    errors += [f"Feature '{f}' is not numeric" for f in catalog.FEATURES
               if f in types and not types[f].startswith(("decimal", *numeric))]
    return errors


def training_report(df: DataFrame) -> DataFrame:
    """Schema errors plus an emptiness check, one row each; no row means valid."""
    spark = df.sparkSession
    schema_rows = spark.createDataFrame([(e,) for e in training_errors(df)], "error string")
    empty = df.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit("Dataset is empty (0 records)").alias("error"))
    return schema_rows.unionByName(empty)
