"""Nested bureau reports as JSON lines, one per customer, derived from the customer table.

Arrays have zero to three elements by formula, so nothing is collected to build a line.  Every fourth
report uses the snake-case names some bureaus send.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake.sources.views import STATUS_RING, bureau_status, has_45, has_49, spread, table


def _rows(count: Column, build) -> Column:
    """Array of ``count`` structs, ``build(i)`` for i = 0.."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), build)).otherwise(
        F.filter(F.transform(F.sequence(F.lit(0), F.lit(0)), build), lambda _: F.lit(False)))


def money(units: Column) -> Column:
    return F.concat(F.format_number(units, 0), F.lit(".50"))


def day(key: Column, i: Column) -> Column:
    return F.date_add(F.lit("1995-01-01").cast("date"), ((key * 31 + i * 400) % 2400).cast("int"))


def day_text(key: Column, i: Column) -> Column:
    d = day(key, i)
    return (F.when((key + i) % 4 == 0, F.date_format(d, "dd/MM/yyyy"))
            .when((key + i) % 4 == 1, F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit(" 00:00:00")))
            .when((key + i) % 4 == 2, F.date_format(d, "yyyy-MM-dd")).otherwise("unknown"))


def status(key: Column, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATUS_RING]), ((key + i * 5) % 12 + 1).cast("int"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns ``key`` and ``payload`` (nested struct as the bureaus name it)."""
    key = F.col("c_custkey")
    alias = key % 4 == 1

    def named(canonical, other, value):
        return [F.when(~alias, value).alias(canonical), F.when(alias, value).alias(other)]

    personal = F.struct(
        F.concat(F.lit("C"), key).alias("consumerID"),
        *named("birthDate", "birth_date", F.concat(
            F.lpad((key % 28 + 1).cast("string"), 2, "0"), F.lit("/"), F.lpad((key % 12 + 1).cast("string"), 2, "0"),
            F.lit("/"), (key % 60 + 1935).cast("string"))),
        (key % 7).cast("string").alias("dependants"),
        *named("employerDetail", "employer", F.when(key % 3 != 0, F.col("c_mktsegment"))),
        *named("nationalIDNo", "national_id", F.when(key % 11 != 0, F.concat(F.lit("GHA-"), key))),
    )
    rating = F.struct(F.when(key % 9 != 0, (key % 5).cast("string")).alias("highestDelinquencyRating"))
    agreements = _rows(key % 4, lambda i: F.struct(
        *named("accountStatusCode", "status_code", status(key, i)),
        *named("monthsInArrears", "months_in_arrears", ((key + i) % 6).cast("string")),
        *named("openingBalanceAmt", "opening_balance_amt", money((key * 37 + i * 5000) % 90000)),
        *named("currentBalanceAmt", "current_balance", money((key * 53 + i * 700) % 60000)),
        *named("dateAccountOpened", "date_opened", day_text(key, i)),
        F.when((key + i) % 3 == 0, F.lit("2001-06-30")).alias("closedDate"),
        F.when((key + i) % 2 == 0, F.concat(F.lit("Type "), (key + i) % 5)).alias("accountType"),
        F.concat(F.lit("Loan "), i).alias("loanType"),
    ))
    months = F.array(F.struct(*[
        F.when((key * 7 + m * 5) % 13 < key % 13 + 1, F.lit("0")).when((key + m) % 11 == 0, F.lit("3")).otherwise("#")
        .alias(f"m{m:02d}") for m in range(1, 25)]))

    def enquiries(offset, count):
        return _rows(count, lambda i: F.struct(
            F.when((key + i) % 3 != 0, F.concat(F.lit("E"), key * 10 + i + offset)).alias("subscriberEnquiryResultID"),
            F.date_format(F.date_add(F.lit("2024-04-19").cast("date"), -((key * 3 + (i + offset) * 50) % 500).cast("int")),
                          "dd/MM/yyyy").alias("dateRequested"),
            F.lit("Application").alias("enquiryReason"), F.lit("Lender").alias("subscriberName")))

    report_45 = F.struct(
        F.struct(bureau_status(has_45(key)).alias("statusCode")).alias("response"),
        personal.alias("personalDetailsSummary"), rating.alias("highestDelinquencyRating"),
        F.struct(
            money((key * 97) % 200000).alias("totalOutstandingdebtGHS"),
            money((key * 13) % 20000).alias("totalMonthlyInstalmentGHS"),
            (key % 8).cast("string").alias("totalActiveAccountsGHS"),
            (key % 12).cast("string").alias("totalNumberofAccountsGHS"),
            (key % 3).cast("string").alias("totalNumberofDishonouredGHS"),
            F.when(key % 6 != 0, (key % 4).cast("string")).alias("totalAccountInArrearGHS"),
            money((key * 11) % 12000).alias("totalAmountInArrearGHS"),
        ).alias("creditAccountSummary"),
        agreements.alias("creditAgreementSummary"), months.alias("accountMonthlyPaymentHistory"),
        enquiries(0, key % 3).alias("enquiryHistory"),
        F.when(key % 5 != 0, F.when(key % 23 == 1, F.array(F.lit("judgement"))).otherwise(F.array().cast("array<string>")))
        .alias("judgementSummary"),
        F.when(key % 31 == 2, F.array(F.lit("default"))).alias("defaults"),
        F.when(key % 3 == 0, F.array(F.lit("cheque"), F.lit("cheque"))).alias("dudCheqEventSummary"),
        _rows(key % 4, lambda i: F.struct(F.concat(F.lit("Plot "), (key + i) % 3).alias("address"))).alias("addressHistory"),
    )
    report_49 = F.struct(
        F.struct(bureau_status(has_49(key)).alias("statusCode")).alias("response"),
        personal.alias("personalDetailsSummary"), rating.alias("highestDelinquencyRating"),
        _rows(key % 3 + 1, lambda i: F.struct(
            status(key, i + 1).alias("accountStatusCode"), ((key + i) % 4).cast("string").alias("monthsInArrears"),
            money((key * 17 + i * 100) % 4000).alias("openingBalanceAmt"))).alias("detailedFacilityInfo"),
        F.struct(money((key * 19) % 7000).alias("highestAmountTaken"), money((key * 23) % 9000).alias("totalOutstandingdebt"),
                 money((key * 29) % 900).alias("totalMonthlyInstalment")).alias("creditAccountSummary"),
        enquiries(1, key % 4).alias("enquiryHistory"),
    )
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "report-customers")
    return customers.select(key.alias("key"), F.struct(
        F.when(key % 10 != 9, report_45).alias("consumer_full_report_45"),
        F.when(has_49(key), report_49).alias("consumer_mobile_report_49"),
    ).alias("payload"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key``, ``line_no`` and the raw JSON ``line`` in the shapes a batch upload may have.

    By key % 6: wrapped payload with a request id, both reports at top level, bare full report, bare mobile
    report, a broken line, and a wrapped payload without a request id.
    """
    key, payload = F.col("key"), F.col("payload")
    shape = key % 6
    request_id = F.concat(F.lit("REQ-"), key)
    line = (
        F.when(shape == 0, F.to_json(F.struct(request_id.alias("request_id"), payload.alias("xds_payload"))))
        .when(shape == 1, F.to_json(F.struct(request_id.alias("request_id"), F.col("payload.*"))))
        .when(shape == 2, F.coalesce(F.to_json(payload["consumer_full_report_45"]), F.lit("{}")))
        .when(shape == 3, F.coalesce(F.to_json(payload["consumer_mobile_report_49"]), F.lit("{}")))
        .when(shape == 4, F.concat(F.lit("{\"request_id\": \"REQ-"), key))
        .otherwise(F.to_json(F.struct(payload.alias("xds_payload"))))
    )
    return payloads(spark, sf_dir).select(key, (key + 1).alias("line_no"), line.alias("line"))
