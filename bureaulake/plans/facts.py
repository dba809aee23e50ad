"""Bureau tables to applicant facts, feature vectors and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.catalog import AsOf
from bureaulake.functions import accounts as acc
from bureaulake.functions import parse
from bureaulake.operators import features
from bureaulake.sources import views


def hit_status(status_45, status_49):
    return (F.when(status_45 == 200, F.lit("HIT")).when(status_49 == 200, F.lit("THIN_FILE"))
            .otherwise("NO_RECORD"))


def account_facts(accounts: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    """Every per-applicant account measure in one aggregation.

    Sums, extremes and flags combine map-side.  The two distinct counts are spread over (applicant, value) before
    they meet, so an applicant with a very large share of the accounts stays harmless.
    """
    c = F.col
    code, arrears, opening = c("status_code"), c("months_in_arrears"), c("opening_balance")
    in_45, in_49 = c("in_45"), c("in_49")
    # Agreements come before mobile facilities where the first of something counts.
    position = F.when(in_45, c("account_id")).otherwise(c("account_id") + (1 << 60))
    total = accounts.groupBy("applicant_id").agg(
        acc.utilisation(c("current_balance"), opening, in_45).alias("utilisation"),
        acc.oldest(parse.parse_date(c("date_opened")), in_45).alias("oldest"),
        acc.closed_good(code, c("closed_date"), in_45).alias("closed_good"),
        F.count_if(in_45).alias("total_accounts"),
        F.count_if(in_45 & (acc.status(code) == "A")).alias("active_accounts"),
        F.count_if(in_45 & (arrears > 0)).alias("accounts_in_arrear"),
        (F.sum(F.when(in_45, arrears)) * 50.0).alias("arrear_amount"),
        F.max(F.when(in_45, arrears)).alias("arrears_max"),
        F.sum(F.when(in_45, opening * (c("applicant_id") % 8) / 200)).alias("debt"),
        F.min(F.when(in_45, c("account_id"))).alias("first_account"),
        F.count_if(in_49).alias("mobile_count"),
        F.max(F.when(in_49, opening * (F.floor(c("applicant_id") / 10) % 9) / 600)).alias("mobile_max"),
        F.count_distinct(acc.normal_text(F.when(in_45, c("account_type")))).alias("product_diversity"),
        F.count_distinct(acc.normal_text(F.when(in_45, c("address")))).alias("distinct_addresses"),
        *[acc.has_status(code, s).alias(n)
          for s, n in (("W", "written_off"), ("G", "charged_off"), ("L", "legal_handover"))],
        *[signal.alias(n) for n, signal in acc.default_signals(code, arrears, position).items()],
        acc.max_repaid_loan(code, opening).alias("max_repaid"),
    )
    return total.withColumn("credit_age", acc.credit_age(c("oldest"), as_of.accounts)).drop("oldest")


def payment_facts(histories: DataFrame) -> DataFrame:
    """On-time months, worst code and running streak per applicant."""
    codes = F.col("codes")
    per_history = histories.select(
        "applicant_id", "position", acc.months_on_time(codes).alias("on_time"),
        acc.leading_on_time(codes).alias("lead"), acc.worst_month(codes).alias("worst"), F.size(codes).alias("length"))
    parts = acc.streak_over_histories(F.col("position"), F.col("lead"), F.col("length"))
    return per_history.groupBy("applicant_id").agg(
        F.sum("on_time").alias("months_on_time"), F.max("worst").alias("worst_month"),
        *[expr.alias(name) for name, expr in parts.items()],
    ).select("applicant_id", "months_on_time", "worst_month",
             acc.streak(*[F.col(n) for n in parts]).alias("current_streak"))


def merged_enquiries(enquiries: DataFrame) -> DataFrame:
    """Union of both enquiry lists, first row per identity, product 45 before 49.

    ``min_by`` keeps one row per key map-side; no window, no sort of a whole applicant.
    """
    key = acc.enquiry_key(F.col("enquiry_id"), F.col("date_requested"), F.col("subscriber"))
    kept = F.struct("source", "position", "enquiry_id", "date_requested", "subscriber")
    return (enquiries.groupBy("applicant_id", key.alias("enquiry_key"))
            .agg(F.min(kept).alias("kept")).select("applicant_id", "enquiry_key", "kept.*"))


def enquiry_facts(merged: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    asked = parse.parse_date(F.col("date_requested"))
    return merged.groupBy("applicant_id").agg(
        acc.enquiries_within(asked, as_of.enquiries, 90).alias("enquiries_3m"),
        acc.enquiries_within(asked, as_of.enquiries, 365).alias("enquiries_12m"),
        F.count(F.lit(1)).alias("enquiries_total"))


def parsed_applicants(people: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    """Personal details as numbers and flags; the age counts only with a full report."""
    c, full = F.col, F.col("status_45") == 200
    rating = c("delinquency_raw")
    return people.select(
        "applicant_id", "request_id", hit_status(c("status_45"), c("status_49")).alias("hit_status"),
        full.alias("has_45"), (c("status_49") == 200).alias("has_49"),
        F.when(full, features.age_years(c("birth_date"), as_of.birth)).alias("applicant_age_years"),
        parse.safe_number(c("dependants")).alias("dependants"), parse.filled(c("employer")).alias("has_employer"),
        parse.filled(c("national_id")).alias("identity_known"),
        F.when(parse.filled(rating), parse.safe_number(rating)).alias("delinquency"),
        "judgement_found", "has_adverse", "bounced_cheques", "instalment_49")


def applicant_facts(spark: SparkSession, sf_dir: str, as_of: AsOf = AsOf()) -> DataFrame:
    """The facts table: all inputs are reduced to one row per applicant before they meet."""
    people = parsed_applicants(views.applicants(spark, sf_dir), as_of)
    account = account_facts(views.accounts(spark, sf_dir), as_of)
    # The payment history hangs on the first agreement, which the account pass already found.
    codes = views.month_codes(F.col("first_account"), F.col("applicant_id"))
    account = account.withColumns({
        "codes": F.when(F.col("first_account").isNotNull(), codes),
    }).withColumns({
        "months_on_time": acc.months_on_time(F.col("codes")),
        "current_streak": acc.leading_on_time(F.col("codes")),
        "worst_arrears": F.greatest(acc.worst_month(F.col("codes")), F.col("arrears_max")),
    })
    asked = enquiry_facts(merged_enquiries(views.enquiries(spark, sf_dir)), as_of)
    joined = people.join(account, "applicant_id", "left").join(asked, "applicant_id", "left")

    def count(name):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    def amount(name, alias=None):
        return F.coalesce(F.col(name), F.lit(0.0)).alias(alias or name)

    return joined.select(
        *people.columns, F.lit(True).alias("has_agreements"),
        amount("utilisation"), count("credit_age"), count("closed_good"), count("total_accounts"),
        count("active_accounts"), count("accounts_in_arrear"), amount("arrear_amount"),
        amount("debt", "outstanding_debt"), amount("mobile_max"), (amount("debt") / 24).alias("instalment_45"),
        count("mobile_count"), count("product_diversity"), count("distinct_addresses"), "max_repaid",
        count("n_accounts"), *[f"first_{s}" for s in catalog.EXCLUDED_STATUS],
        *[F.coalesce(F.col(n), F.lit(False)).alias(n)
          for n in ("saw_default", "saw_decided", "written_off", "charged_off", "legal_handover")],
        count("months_on_time"), count("worst_arrears"), count("current_streak"),
        count("enquiries_3m"), count("enquiries_12m"), count("enquiries_total"),
    )


def feature_table(spark: SparkSession, sf_dir: str, as_of: AsOf = AsOf(), impute: bool = True) -> DataFrame:
    return features.feature_vector(applicant_facts(spark, sf_dir, as_of), impute=impute)


def decisions(spark: SparkSession, sf_dir: str, flow: str = "training", as_of: AsOf = AsOf(), **options) -> DataFrame:
    return features.score(feature_table(spark, sf_dir, as_of), flow, **options)
