"""Nested bureau reports: parse, alias normalisation, extraction, flattening and facts.

One report is one row; its arrays are handled with higher-order functions, so none of this shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureaulake import catalog
from bureaulake.catalog import AsOf
from bureaulake.functions import accounts as acc
from bureaulake.functions import parse
from bureaulake.operators.features import age_years

# Canonical field -> other names it may arrive under, in order of preference.
AGREEMENT_ALIASES = {
    "accountStatusCode": ["status_code", "account_status_code"],
    "monthsInArrears": ["months_in_arrears"],
    "openingBalanceAmt": ["opening_balance_amt", "credit_limit"],
    "currentBalanceAmt": ["current_balance", "current_balance_amt"],
    "dateAccountOpened": ["date_opened", "dateOpened", "date_account_opened"],
    "closedDate": ["closed_date"],
    "subscriberName": ["subscriber_name"],
    "accountNo": ["account_no"],
    "accountType": ["facility_type", "account_type"],
    "loanType": ["loan_type", "facility_type"],
    "creditLimit": ["credit_limit"],
}
PERSONAL_ALIASES = {
    "birthDate": ["birth_date"],
    "consumerID": ["consumer_id"],
    "firstName": ["first_name"],
    "surname": ["last_name", "lastName"],
    "otherNames": ["other_names"],
    "nationalIDNo": ["national_id"],
    "employerDetail": ["employer"],
    "dependants": [],
    "gender": [],
    "phone": ["phoneNumber"],
    "email": [],
    "address": ["residentialAddress"],
    "maritalStatus": ["marital_status"],
}
SUMMARY_ALIASES = {
    "totalOutstandingdebtGHS": ["total_outstanding_debt_ghs"],
    "totalMonthlyInstalmentGHS": ["total_monthly_instalment_ghs"],
    "totalActiveAccountsGHS": ["total_accounts_good_standing", "total_active_accounts_ghs"],
    "totalNumberofAccountsGHS": ["total_accounts", "total_number_of_accounts_ghs"],
    "totalClosedAccountsGHS": ["total_closed_accounts_ghs"],
    "totalNumberofDishonouredGHS": ["total_dishonoured_cheques", "total_numberof_dishonoured_ghs"],
    "totalAccountInArrearGHS": ["total_accounts_in_arrear", "total_account_in_arrear_ghs"],
    "totalAmountInArrearGHS": ["total_arrear_amount_ghs", "total_amount_in_arrear_ghs"],
    "highestDelinquencyRating": ["delinquency_rating"],
}
MOBILE_SUMMARY_FIELDS = ["highestAmountTaken", "totalOutstandingdebt", "totalMonthlyInstalment"]
ENQUIRY_FIELDS = ["subscriberEnquiryResultID", "dateRequested", "enquiryReason", "subscriberName"]
ADDRESS_FIELDS = ["address", "residentialAddress", "postalAddress"]
MONTHS = [f"m{m:02d}" for m in range(1, 25)]
# Date fields that rank array elements.
LATEST_KEYS = ["dateRequested", "dateAccountOpened", "dateOpened", "date_opened", "closedDate", "closed_date",
               "updatedAt", "createdAt"]
# Columns a flat row of a full report must fill.
REQUIRED_FLAT = ["consumer_full_report_45.response.statusCode",
                 "consumer_full_report_45.creditAgreementSummary.accountStatusCode",
                 "consumer_full_report_45.creditAgreementSummary.monthsInArrears",
                 "consumer_full_report_45.creditAgreementSummary.openingBalanceAmt"]

_TEXT = T.StringType()


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in dict.fromkeys(names)])


def _with_aliases(aliases: dict, extra=()) -> T.StructType:
    return _strings([*aliases, *[a for names in aliases.values() for a in names], *extra])


RESPONSE = T.StructType([T.StructField("statusCode", T.LongType())])
SUMMARY = _with_aliases(SUMMARY_ALIASES, MOBILE_SUMMARY_FIELDS)
RATING = _strings(["highestDelinquencyRating"])
REPORT_45 = T.StructType([
    T.StructField("response", RESPONSE), T.StructField("personalDetailsSummary", _with_aliases(PERSONAL_ALIASES)),
    T.StructField("highestDelinquencyRating", RATING), T.StructField("creditAccountSummary", SUMMARY),
    T.StructField("creditAgreementSummary", T.ArrayType(_with_aliases(AGREEMENT_ALIASES))),
    T.StructField("accountMonthlyPaymentHistory", T.ArrayType(_strings(MONTHS))),
    T.StructField("enquiryHistory", T.ArrayType(_strings(ENQUIRY_FIELDS))),
    *[T.StructField(n, T.ArrayType(_TEXT)) for n in ("judgementSummary", "defaults", "adverseDetails", "dudCheqEventSummary")],
    T.StructField("addressHistory", T.ArrayType(_strings(ADDRESS_FIELDS))),
])
REPORT_49 = T.StructType([
    T.StructField("response", RESPONSE), T.StructField("personalDetailsSummary", _with_aliases(PERSONAL_ALIASES)),
    T.StructField("highestDelinquencyRating", RATING),
    T.StructField("detailedFacilityInfo", T.ArrayType(_with_aliases(AGREEMENT_ALIASES))),
    T.StructField("creditAccountSummary", SUMMARY),
    T.StructField("enquiryHistory", T.ArrayType(_strings(ENQUIRY_FIELDS))),
])
PAYLOAD = T.StructType([
    T.StructField("consumer_full_report_45", REPORT_45), T.StructField("consumer_mobile_report_49", REPORT_49)])
SUBJECTS = T.ArrayType(_strings(["uniqueID"]))
# One line may be a wrapped payload, two reports, or a bare report of either kind.
LINE = T.StructType([
    T.StructField("request_id", _TEXT), T.StructField("xds_payload", PAYLOAD), *PAYLOAD.fields,
    *REPORT_45.fields, T.StructField("detailedFacilityInfo", T.ArrayType(_with_aliases(AGREEMENT_ALIASES))),
    T.StructField("subjectList", SUBJECTS), T.StructField("_broken", _TEXT),
])


def apply_aliases(struct: Column, aliases: dict, extra=()) -> Column:
    """Struct with canonical names: the canonical value when filled, else the first filled alias."""
    fields = [F.coalesce(parse.non_blank(struct[n], *[struct[a] for a in names]), struct[n]).alias(n)
              for n, names in aliases.items()]
    return F.struct(*fields, *[struct[n].alias(n) for n in extra])


def normalise(payload: Column) -> Column:
    """Payload with canonical names in personal details, summaries, agreements and facilities.

    The result is plain struct construction, so a reference to one leaf later simplifies to that leaf and
    everything not asked for disappears from the plan.  An absent report has null in every leaf.
    """
    def rebuilt(report, schema, summary_extra=()):
        changed = {
            "personalDetailsSummary": lambda c: apply_aliases(c, PERSONAL_ALIASES),
            "creditAccountSummary": lambda c: apply_aliases(c, SUMMARY_ALIASES, summary_extra),
            "creditAgreementSummary": lambda c: F.transform(c, lambda a: apply_aliases(a, AGREEMENT_ALIASES)),
            "detailedFacilityInfo": lambda c: F.transform(c, lambda a: apply_aliases(a, AGREEMENT_ALIASES)),
        }
        keep = lambda c: c
        return F.struct(*[changed.get(f.name, keep)(report[f.name]).alias(f.name) for f in schema.fields])

    return F.struct(
        rebuilt(payload["consumer_full_report_45"], REPORT_45).alias("consumer_full_report_45"),
        rebuilt(payload["consumer_mobile_report_49"], REPORT_49, MOBILE_SUMMARY_FIELDS).alias("consumer_mobile_report_49"))


def present(report: Column) -> Column:
    return F.coalesce(report["response"]["statusCode"] == 200, F.lit(False))


def hit_status(payload: Column) -> Column:
    return (F.when(present(payload["consumer_full_report_45"]), F.lit("HIT"))
            .when(present(payload["consumer_mobile_report_49"]), F.lit("THIN_FILE")).otherwise("NO_RECORD"))


def extract_45(report: Column) -> dict[str, Column]:
    """Scalars of a full report with flags for inputs that were present."""
    personal, summary = report["personalDetailsSummary"], report["creditAccountSummary"]
    rating = report["highestDelinquencyRating"]["highestDelinquencyRating"]
    dishonoured = parse.safe_number(summary["totalNumberofDishonouredGHS"])

    def filled_list(name):
        return F.coalesce(F.size(report[name]) > 0, F.lit(False))

    return {
        "birth_date": personal["birthDate"],
        "has_birth_date_input": parse.filled(personal["birthDate"]),
        "dependants": parse.safe_number(personal["dependants"]),
        "has_employer_detail": F.coalesce(personal["employerDetail"] != "", F.lit(False)),
        "national_id_no": personal["nationalIDNo"],
        "has_national_id_input": parse.filled(personal["nationalIDNo"]),
        "highest_delinquency_rating_raw": parse.safe_number(rating),
        "has_highest_delinquency_input": parse.filled(rating),
        "total_outstanding_debt_ghs": parse.safe_number(summary["totalOutstandingdebtGHS"]),
        "total_monthly_instalment_ghs": parse.safe_number(summary["totalMonthlyInstalmentGHS"]),
        "num_active_accounts": parse.safe_number(summary["totalActiveAccountsGHS"]),
        "num_accounts_total": parse.safe_number(summary["totalNumberofAccountsGHS"]),
        "num_closed_accounts_total": parse.safe_number(summary["totalClosedAccountsGHS"]),
        "num_dishonoured_total": dishonoured,
        "total_account_in_arrear_ghs": parse.safe_number(summary["totalAccountInArrearGHS"]),
        "has_total_account_in_arrear_input": parse.filled(summary["totalAccountInArrearGHS"]),
        "total_arrear_amount_ghs": parse.safe_number(summary["totalAmountInArrearGHS"]),
        "num_bounced_cheques": F.when(dishonoured != 0, dishonoured.cast("long")).otherwise(
            F.coalesce(F.size(report["dudCheqEventSummary"]), F.lit(0)).cast("long")),
        "has_judgement": filled_list("judgementSummary"),
        "has_judgement_input": report["judgementSummary"].isNotNull(),
        "has_adverse_default": filled_list("defaults") | filled_list("adverseDetails"),
        "has_credit_agreements_input": report["creditAgreementSummary"].isNotNull(),
    }


def extract_49(report: Column) -> dict[str, Column]:
    summary = report["creditAccountSummary"]
    return {
        "mobile_loan_history_count": F.coalesce(F.size(report["detailedFacilityInfo"]), F.lit(0)),
        "mobile_max_loan_ghs": parse.safe_number(summary["highestAmountTaken"]),
        "mobile_total_outstanding_ghs": parse.safe_number(summary["totalOutstandingdebt"]),
        "mobile_total_monthly_instalment_ghs": parse.safe_number(summary["totalMonthlyInstalment"]),
    }


def thin_file_overrides(payload: Column) -> dict[str, Column]:
    """Personal details and rating of the mobile report, filled only for thin files."""
    report, thin = payload["consumer_mobile_report_49"], hit_status(payload) == "THIN_FILE"
    personal = report["personalDetailsSummary"]
    return {
        "thin_dependants": F.when(thin, parse.safe_number(personal["dependants"])),
        "thin_has_employer": F.when(thin, F.coalesce(personal["employerDetail"] != "", F.lit(False))),
        "thin_rating": F.when(thin, parse.safe_number(report["highestDelinquencyRating"]["highestDelinquencyRating"])),
    }


def merged_enquiries(first: Column, second: Column) -> Column:
    """Distinct enquiries of two lists, the earliest occurrence per identity kept.

    Sorting by identity and position makes equal identities neighbours, so a long list costs n log n.
    """
    both = F.concat(F.coalesce(first, F.array()), F.coalesce(second, F.array()))
    keyed = F.transform(both, lambda e, i: F.struct(
        acc.enquiry_key(e["subscriberEnquiryResultID"], e["dateRequested"], e["subscriberName"]).alias("k"),
        i.alias("i"), e["dateRequested"].alias("asked")))
    return F.array_sort(keyed)


def first_of_run(sorted_col: str) -> Column:
    """Elements whose identity differs from the one before; ``sorted_col`` is a column of the input."""
    rows = F.col(sorted_col)
    return F.filter(rows, lambda e, i: (i == 0) | (F.get(rows, i - 1)["k"] != e["k"]))


def facts(reports: DataFrame, as_of: AsOf = AsOf(), payload: str = "payload") -> DataFrame:
    """The facts table of ``operators.features`` from a column of normalised payloads; no shuffle."""
    p = F.col(payload)
    full, mobile = p["consumer_full_report_45"], p["consumer_mobile_report_49"]
    base = reports.withColumns({
        "hit_status": hit_status(p), "has_45": present(full), "has_49": present(mobile),
    }).withColumns({
        "_full": F.when(F.col("has_45"), full), "_mobile": F.when(F.col("has_49"), mobile),
    }).withColumns({
        "_codes": F.flatten(F.transform(F.col("_full")["accountMonthlyPaymentHistory"], lambda h: F.array(
            *[F.coalesce(h[m], F.lit("")) for m in MONTHS]))),
        "_enquiries": merged_enquiries(F.col("_full")["enquiryHistory"], F.col("_mobile")["enquiryHistory"]),
        "_agreements": F.coalesce(F.col("_full")["creditAgreementSummary"], F.array()),
        "_facilities": F.coalesce(F.col("_mobile")["detailedFacilityInfo"], F.array()),
    }).withColumns({"_asked": F.transform(first_of_run("_enquiries"), lambda e: parse.parse_date(e["asked"]))})
    x45, x49, thin = extract_45(F.col("_full")), extract_49(F.col("_mobile")), thin_file_overrides(p)
    agreements, codes = F.col("_agreements"), F.col("_codes")
    statuses = F.transform(F.concat(
        F.transform(agreements, lambda a: a["accountStatusCode"]),
        F.transform(F.col("_facilities"), lambda a: a["accountStatusCode"])), acc.status)
    ratios = F.transform(
        F.filter(agreements, lambda a: parse.safe_number(a["openingBalanceAmt"]) > 0),
        lambda a: parse.safe_number(a["currentBalanceAmt"]) / parse.safe_number(a["openingBalanceAmt"]))
    mean = F.aggregate(ratios, F.lit(0.0), lambda s, r: s + r) / F.when(F.size(ratios) > 0, F.size(ratios))
    arrears = F.transform(agreements, lambda a: parse.whole(a["monthsInArrears"]))
    opened = F.transform(agreements, lambda a: parse.parse_date(a["dateAccountOpened"]))
    good = F.filter(agreements, lambda a: F.coalesce(a["closedDate"] != "", F.lit(False))
                    & ~acc.status(a["accountStatusCode"]).isin(catalog.NOT_GOOD_STATUS))

    def distinct(array, *names):
        texts = F.transform(array, lambda a: acc.normal_text(*[a[n] for n in names]))
        return F.size(F.array_distinct(F.array_compact(texts)))

    def within(days):
        return F.size(F.filter(F.col("_asked"), lambda d: F.date_diff(F.lit(as_of.enquiries), d) <= days))

    no_arrears = F.lit(0).cast("long")
    out = base.select(
        *[c for c in reports.columns if c != payload], "hit_status", "has_45", "has_49",
        F.when(F.col("has_45"), age_years(x45["birth_date"], as_of.birth)).alias("applicant_age_years"),
        F.coalesce(F.when(F.col("has_45"), x45["dependants"]), thin["thin_dependants"]).alias("dependants"),
        F.coalesce(F.when(F.col("has_45"), x45["has_employer_detail"]), thin["thin_has_employer"]).alias("has_employer"),
        x45["has_national_id_input"].alias("identity_known"),
        F.when(F.col("has_45"), F.when(x45["has_highest_delinquency_input"], x45["highest_delinquency_rating_raw"]))
        .otherwise(thin["thin_rating"]).alias("delinquency"),
        F.when(x45["has_total_account_in_arrear_input"], x45["total_account_in_arrear_ghs"]).alias("accounts_in_arrear"),
        x45["total_arrear_amount_ghs"].alias("arrear_amount"),
        x45["total_outstanding_debt_ghs"].alias("outstanding_debt"),
        x45["total_monthly_instalment_ghs"].alias("instalment_45"),
        x49["mobile_total_monthly_instalment_ghs"].alias("instalment_49"),
        x45["num_active_accounts"].alias("active_accounts"), x45["num_accounts_total"].alias("total_accounts"),
        x45["num_bounced_cheques"].alias("bounced_cheques"),
        F.when(x45["has_judgement_input"], x45["has_judgement"]).alias("judgement_found"),
        x45["has_adverse_default"].alias("has_adverse"), x45["has_credit_agreements_input"].alias("has_agreements"),
        F.coalesce(acc.months_on_time(codes), F.lit(0)).alias("months_on_time"),
        F.coalesce(acc.leading_on_time(codes), F.lit(0)).alias("current_streak"),
        F.greatest(F.coalesce(acc.worst_month(codes), F.lit(0)).cast("long"),
                   F.coalesce(F.array_max(arrears), no_arrears)).alias("worst_arrears"),
        F.least(F.greatest(F.coalesce(mean, F.lit(0.0)), F.lit(0.0)), F.lit(1.2)).alias("utilisation"),
        acc.credit_age(F.array_min(F.array_compact(opened)), as_of.accounts).alias("credit_age"),
        F.size(good).alias("closed_good"),
        distinct(agreements, "accountType", "loanType", "subscriberName").alias("product_diversity"),
        distinct(F.coalesce(F.col("_full")["addressHistory"], F.array()), *ADDRESS_FIELDS).alias("distinct_addresses"),
        x49["mobile_loan_history_count"].alias("mobile_count"), x49["mobile_max_loan_ghs"].alias("mobile_max"),
        *[F.array_contains(statuses, s).alias(n)
          for s, n in (("W", "written_off"), ("G", "charged_off"), ("L", "legal_handover"))],
        within(90).alias("enquiries_3m"), within(365).alias("enquiries_12m"), F.size("_asked").alias("enquiries_total"),
    )
    return out


def array_date(text: Column) -> Column:
    """Date of an array element: the part before ``T`` or a blank."""
    return parse.parse_date(F.regexp_extract(F.trim(text), r"^([^T ]+)", 1))


def latest_element(array: Column, fields: list[str]) -> Column:
    """Element with the latest date, the first one on ties, the last element when none is dated."""
    keys = [k for k in LATEST_KEYS if k in fields]
    if not keys:
        return F.get(array, F.size(array) - 1)
    ranked = F.transform(array, lambda e, i: F.struct(
        F.coalesce(*[array_date(e[k]) for k in keys]).alias("d"), (-i).alias("i"), e.alias("e")))
    dated = F.filter(ranked, lambda r: r["d"].isNotNull())
    return F.coalesce(F.array_max(dated)["e"], F.get(array, F.size(array) - 1))


def flatten(df: DataFrame, column: str) -> DataFrame:
    """Dotted columns for every leaf of a struct column; an array is represented by its latest element.

    The walk is over the schema on the driver; the data are touched by one projection.
    """
    leaves: list[Column] = []

    def walk(path: str, value: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.ArrayType):
            fields = kind.elementType.names if isinstance(kind.elementType, T.StructType) else []
            return walk(path, latest_element(value, fields), kind.elementType)
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(f"{path}.{field.name}" if path else field.name, value[field.name], field.dataType)
            return None
        leaves.append(value.alias(path))
        return None

    walk("", F.col(column), df.schema[column].dataType)
    return df.select(*[c for c in df.columns if c != column], *leaves)


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def unflatten(df: DataFrame, keep: list[str]) -> DataFrame:
    """Nested payload from dotted columns; each array has the one element the flat row carries."""
    def build(prefix: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.StructType):
                return F.array(build(prefix, kind.elementType))
            leaf = quoted(prefix) if prefix in df.columns else F.lit(None).cast("string")
            return F.when(leaf.isNull(), F.array().cast("array<string>")).otherwise(F.array(leaf))
        if isinstance(kind, T.StructType):
            return F.struct(*[build(f"{prefix}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        if prefix not in df.columns:
            return F.lit(None).cast(kind)
        return quoted(prefix) if isinstance(kind, T.StringType) else quoted(prefix).try_cast(kind)

    def report(name, kind):
        whole = build(name, kind)
        return F.when(parse.safe_number(quoted(f"{name}.response.statusCode")) == 200, whole).alias(name)

    return df.select(*keep, F.struct(
        report("consumer_full_report_45", REPORT_45), report("consumer_mobile_report_49", REPORT_49)).alias("payload"))


def flat_contract_errors(df: DataFrame) -> Column:
    """Why a flat row cannot be scored, or null: full report with its agreement fields, or mobile report."""
    def code(name):
        return parse.whole(parse.number_or_null(quoted(name)))

    has_45 = code("consumer_full_report_45.response.statusCode") == 200
    has_49 = code("consumer_mobile_report_49.response.statusCode") == 200
    missing = F.array_compact(F.array(*[F.when(~parse.filled(quoted(n)), F.lit(n)) for n in REQUIRED_FLAT]))
    return (F.when(has_45 & (F.size(missing) > 0), F.concat(F.lit("missing: "), F.array_join(missing, ",")))
            .when(~has_45 & ~has_49, F.lit("no product 45 and no product 49")))


def restore_required(masked: DataFrame, original_prefix: str) -> dict[str, Column]:
    """Required columns that masking blanked, refilled from ``<prefix><name>`` columns on a full-report row."""
    status = quoted(original_prefix + REQUIRED_FLAT[0])
    is_hit = parse.safe_number(status) == 200
    return {n: F.when(is_hit & ~parse.filled(quoted(n)), quoted(original_prefix + n)).otherwise(quoted(n))
            for n in REQUIRED_FLAT}


# --- batch lines ---------------------------------------------------------------------------------------


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds ``obj`` (tolerant parse of ``line``) and ``error`` for lines that are no JSON object."""
    parsed = F.from_json("line", LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    out = lines.withColumn("obj", parsed)
    bad = F.col("obj").isNull() | F.col("obj._broken").isNotNull()
    return out.withColumn("error", F.when(bad, F.concat(F.lit("Line "), F.col("line_no"), F.lit(": invalid JSON"))))


def shape(obj: Column) -> Column:
    """Which layout a line has."""
    return (F.when(obj["xds_payload"].isNotNull(), F.lit("wrapped"))
            .when(obj["consumer_full_report_45"].isNotNull() | obj["consumer_mobile_report_49"].isNotNull(), F.lit("reports"))
            .when(obj["detailedFacilityInfo"].isNotNull(), F.lit("bare_49")).otherwise("bare_45"))


def payload_of(obj: Column) -> Column:
    """Nested payload of a line in any of the four layouts."""
    bare_45 = F.struct(*[obj[f.name].alias(f.name) for f in REPORT_45.fields])
    bare_49 = F.struct(*[obj[f.name].alias(f.name) for f in REPORT_49.fields])
    nothing_45, nothing_49 = F.lit(None).cast(REPORT_45), F.lit(None).cast(REPORT_49)
    kind = shape(obj)

    def pair(full, mobile):
        return F.struct(full.alias("consumer_full_report_45"), mobile.alias("consumer_mobile_report_49"))

    return (F.when(kind == "wrapped", obj["xds_payload"])
            .when(kind == "reports", pair(obj["consumer_full_report_45"], obj["consumer_mobile_report_49"]))
            .when(kind == "bare_49", pair(nothing_45, bare_49)).otherwise(pair(bare_45, nothing_49)))


def request_id(obj: Column, line: Column, line_no: Column) -> Column:
    """Explicit id, else consumer id, else first subject id, else a hash of the line (stable on re-run)."""
    kind = shape(obj)
    reports = (obj["xds_payload"]["consumer_full_report_45"], obj["xds_payload"]["consumer_mobile_report_49"],
               obj["consumer_full_report_45"], obj["consumer_mobile_report_49"])
    ids = [r["personalDetailsSummary"]["consumerID"] for r in reports]
    consumer = (F.when(kind == "wrapped", F.when(reports[0].isNotNull(), ids[0]).otherwise(ids[1]))
                .when(kind == "reports", F.when(reports[2].isNotNull(), ids[2]).otherwise(ids[3]))
                .otherwise(obj["personalDetailsSummary"]["consumerID"]))
    subject = F.get(obj["subjectList"], F.lit(0))["uniqueID"]
    fallback = F.concat(F.lit("inference-batch-L"), line_no, F.lit("-"), F.substring(F.sha2(line, 256), 1, 12))
    return F.coalesce(
        F.when(parse.filled(obj["request_id"]), F.trim(obj["request_id"])),
        F.when(parse.filled(consumer), F.concat(F.lit("inference-"), consumer)),
        F.when(parse.filled(subject), F.concat(F.lit("inference-"), subject)), fallback)
