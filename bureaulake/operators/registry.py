"""Latest-version lookups, artefact reuse, champion rules and the append-only audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.operators.ranking import row_numbers


def latest(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``; one partial aggregate, no window."""
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(v) for v in values])
    return df.groupBy(*keys).agg(F.max(ranked).alias("_top")).select(*keys, *[F.col(f"_top.{v}").alias(v) for v in values])


def first(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order``."""
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(v) for v in values])
    return df.groupBy(*keys).agg(F.min(ranked).alias("_top")).select(*keys, *[F.col(f"_top.{v}").alias(v) for v in values])


def version_numbers(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``mini_version`` 0, 1, 2.. per key along a numeric column, also for a key with very many rows."""
    return row_numbers(df, keys, order, "_n").withColumn("mini_version", F.col("_n") - 1).drop("_n")


def reuse(requests: DataFrame, artefacts: DataFrame, keys: list[str]) -> DataFrame:
    """Requests with the latest artefact for their key; ``reused`` tells whether one exists."""
    return requests.join(artefacts, keys, "left").withColumn("reused", F.col("version").isNotNull())


def champion_gate(challengers: DataFrame, champions: DataFrame) -> DataFrame:
    """Promote when there is no champion or the challenger is at least as good."""
    joined = challengers.join(champions.select(
        "model_type", F.col("version").alias("champion_version"), F.col("metric").alias("champion_value")), "model_type", "left")
    return joined.select("model_type", F.col("metric").alias("new_value"), "champion_version", "champion_value",
                         (F.col("champion_value").isNull() | (F.col("metric") >= F.col("champion_value"))).alias("promote"))


def champion_snapshot(spark: SparkSession, latest_models: DataFrame) -> DataFrame:
    """All model types with their latest version, NOT_REGISTERED where there is none."""
    kinds = spark.createDataFrame([(m,) for m in catalog.MODELS], "model_type string")
    return kinds.join(latest_models, "model_type", "left").withColumn(
        "status", F.when(F.col("version").isNull(), F.lit("NOT_REGISTERED")).otherwise("CHAMPION"))


def not_yet_stored(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is not stored, one per key."""
    return new.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti")


def visible_decisions(audit: DataFrame, lookups: DataFrame, days: int = 30) -> DataFrame:
    """Newest decision of the same id at most ``days`` before the lookup day.

    Both sides are reduced to one row per (id, day) first and cut into blocks of ``days + 1`` days. A lookup can only see decisions of
    its own block and the last one of the block before, which is carried over the edge as one row. So one ordered pass within
    (id, block) finds the newest decision; such a group has at most a row per day and side, however often an id occurs.
    """
    size = days + 1

    def block(day):
        return F.floor(F.unix_date(day) / size).cast("int")

    daily = latest(audit, ["request_id", "decision_date"], [F.col("audit_id")], ["decision", "audit_id"])
    given = daily.select("request_id", block(F.col("decision_date")).alias("block"), F.col("decision_date").alias("day"),
                         F.struct("decision", "audit_id", "decision_date").alias("seen"))
    carried = latest(given, ["request_id", "block"], [F.col("day")], ["day", "seen"]).select("request_id", (F.col("block") + 1).alias("block"), "day", "seen")
    asked = lookups.select("request_id", "asked_on").distinct().select(
        "request_id", block(F.col("asked_on")).alias("block"), F.col("asked_on").alias("day"), F.lit(None).cast(given.schema["seen"].dataType).alias("seen"))
    rows = given.withColumn("side", F.lit(0)).unionByName(carried.withColumn("side", F.lit(0))).unionByName(asked.withColumn("side", F.lit(1)))
    along = Window.partitionBy("request_id", "block").orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("seen", F.last("seen", ignorenulls=True).over(along)).filter("side = 1")
    found = found.filter(F.col("seen.decision_date") >= F.date_sub("day", days)).select("request_id", F.col("day").alias("asked_on"), "seen.*")
    return lookups.join(found, ["request_id", "asked_on"], "left")
