"""Bureau tables as views over the driver's star schema.

Every function reads whole parquet tables lazily and returns a DataFrame.  The rules are deterministic
integer arithmetic, so a SQL engine can restate them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake.functions.bins import case
from bureaulake.sources import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table in files of a few thousand each: a table of few bytes is read by one task, however much work each row brings.

    Dealing them out by a shuffle would not do: filters on what is made of a row move below it.
    """
    return scratch.written(df, name, rows=5_000)


def has_45(key: Column) -> Column:
    return (key % 10) <= 6


def has_49(key: Column) -> Column:
    return ((key % 10) < 3) | (key % 10).isin(7, 8)


def bureau_status(present: Column) -> Column:
    return F.when(present, F.lit(200)).otherwise(404)


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with personal details and the bureau response codes."""
    key = F.col("c_custkey")
    birth = F.date_add(F.lit("1930-01-01").cast("date"), ((key * 7919) % 27000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.alias("applicant_id"),
        F.concat(F.lit("REQ-"), key).alias("request_id"),
        bureau_status(has_45(key)).alias("status_45"),
        bureau_status(has_49(key)).alias("status_49"),
        F.when(key % 17 != 0, F.date_format(birth, "dd/MM/yyyy")).alias("birth_date"),
        (key % 7).cast("string").alias("dependants"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("employer"),
        F.when(key % 11 != 0, F.concat(F.lit("GHA-"), key)).alias("national_id"),
        (key % 5).cast("string").alias("delinquency_raw"),
        (key % 23 == 0).alias("judgement_found"),
        (key % 29 == 0).alias("has_adverse"),
        F.least(key % 13, F.lit(3)).alias("bounced_cheques"),
        ((key % 4) * 150).cast("double").alias("instalment_49"),
    )


# Status letters by o_orderkey % 12.
STATUS_RING = ["A", "A", "A", "A", "C", "C", "P", "T", "W", "G", "L", "D"]


def account_status(order_key: Column) -> Column:
    slot = order_key % 12
    ring = F.element_at(F.array(*[F.lit(s) for s in STATUS_RING]), (slot + 1).cast("int"))
    return F.when((slot < 8) | (order_key % 53).isin(8, 21), ring).otherwise("A")


def months_in_arrears(order_key: Column) -> Column:
    return F.when(order_key % 29 < 3, order_key % 5).otherwise(0)


def day_text(day: Column, order_key: Column) -> Column:
    """A date as text in one of the three layouts bureaus send."""
    return case([
        (order_key % 3 == 0, F.date_format(day, "dd/MM/yyyy")),
        (order_key % 3 == 1, F.date_format(day, "yyyy/MM/dd")),
    ], F.date_format(day, "yyyy-MM-dd"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit agreements and mobile facilities, one row per order of an applicant with a bureau report.

    ``in_45`` marks agreement rows, ``in_49`` mobile facility rows; a row may be both.  Line items are
    reduced to one row per order before the join, so the join is one to one.
    """
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    in_45 = has_45(cust)
    in_49 = has_49(cust) & (F.col("o_orderpriority") == "1-URGENT")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        (F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))) / 2).alias("half_open"),
        F.max("l_shipdate").alias("last_ship"),
    )
    orders = table(spark, sf_dir, "orders").filter(in_45 | in_49)
    return orders.join(lines, order == F.col("l_orderkey"), "left").select(
        cust.alias("applicant_id"), order.alias("account_id"), in_45.alias("in_45"), in_49.alias("in_49"),
        account_status(order).alias("status_code"),
        months_in_arrears(order).alias("months_in_arrears"),
        F.col("o_totalprice").alias("opening_balance"),
        F.coalesce(F.col("half_open"), F.lit(0.0)).alias("current_balance"),
        day_text(F.to_date("o_orderdate"), order).alias("date_opened"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("last_ship", "yyyy-MM-dd")).alias("closed_date"),
        F.col("o_orderpriority").alias("account_type"),
        F.concat(F.lit(" Plot "), order % (cust % 3 + 1)).alias("address"),
    )


def month_codes(order_key: Column, cust: Column) -> Column:
    """Twenty-four payment codes of one history."""
    def code(k):
        draw = (order_key * 31 + k * 17) % 13
        return case([
            (k > 24 - (cust % 4) * 6, ""),
            (draw < 13 - cust % 10, "0"),
            ((draw == 12) & (cust % 3 == 0), (order_key % 6 + 1).cast("string")),
        ], "#")

    return F.transform(F.sequence(F.lit(1), F.lit(24)), code)


def payment_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment history per applicant with a full report, on its lowest order key."""
    cust = F.col("o_custkey")
    first = table(spark, sf_dir, "orders").filter(has_45(cust)).groupBy("o_custkey").agg(
        F.min("o_orderkey").alias("order_key"))
    return first.select(
        cust.alias("applicant_id"), F.lit(1).alias("position"), month_codes(F.col("order_key"), cust).alias("codes"))


def enquiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enquiry rows of both reports; ``source`` 45 sorts before 49, clicks occur in both."""
    ev = F.col("event_id")
    cust = F.col("user_id") * 10 + ev % 10
    base = table(spark, sf_dir, "events").select(
        cust.alias("applicant_id"), ev.alias("position"), "event_type",
        F.when(ev % 5 != 0, ev.cast("string")).alias("enquiry_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_requested"),
        F.concat(F.lit("Lender "), F.upper("event_type")).alias("subscriber"),
    )
    sources = F.array_compact(F.array(
        F.when(F.col("event_type").isin("view", "click", "signup") & has_45(F.col("applicant_id")), F.lit(45)),
        F.when(F.col("event_type").isin("click", "purchase", "error") & has_49(F.col("applicant_id")), F.lit(49)),
    ))
    return base.select("*", F.explode(sources).alias("source"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model results by formula, for operators that only consume them."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("applicant_id"), F.concat(F.lit("REQ-"), key).alias("request_id"),
        ((key * 37) % 1000 / 1000.0).alias("probability_of_default"),
        (F.lit(-0.3) - (key * 53) % 400 / 1000.0).alias("anomaly_raw"),
        (F.lit(500.0) + (key * 97) % 12000).alias("recommended_loan_amount"),
        (key % 4).cast("int").alias("income_tier"),
        ((key * 13) % 100 / 100.0).alias("income_confidence"),
    )
