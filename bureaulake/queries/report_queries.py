"""Queries: nested reports, flat rows, batch lines, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import parse
from bureaulake.operators import batches, features, reports
from bureaulake.queries.ctes import FEATURE_NAMES, sql
from bureaulake.sources import reports as source
from bureaulake.sources import scratch
from bureaulake.sources.views import table

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


# The report formulas restated; every list has at most three elements.
_KEYS = """SELECT c_custkey AS k, c_mktsegment AS seg, c_custkey % 10 <= 6 AS hit, c_custkey % 10 <> 9 AS has_full,
  (c_custkey % 10 < 3 OR c_custkey % 10 IN (7, 8)) AS mobile FROM customer"""
_AGR = """SELECT k, i, (['A','A','A','A','C','C','P','T','W','G','L','D'])[(k + i * 5) % 12 + 1] AS code, (k + i) % 6 AS arrears,
  (k * 37 + i * 5000) % 90000 + 0.5e0 AS opening, (k * 53 + i * 700) % 60000 + 0.5e0 AS current,
  CASE WHEN (k + i) % 4 <> 3 THEN DATE '1995-01-01' + CAST((k * 31 + i * 400) % 2400 AS INTEGER) END AS opened,
  CASE WHEN (k + i) % 3 = 0 THEN DATE '2001-06-30' END AS closed,
  CASE WHEN (k + i) % 2 = 0 THEN 'Type ' || ((k + i) % 5) END AS kind
FROM keys, range(0, 3) r(i) WHERE i < k % 4 AND has_full"""
_CTE = {"keys": _KEYS, "agr": _AGR}
_BIRTH = "lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || '/' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '/' || (k % 60 + 1935)"


def _normal(spark, d):
    # Parse in a projection of its own: the many field references after it then share one parse.
    text = source.payloads(spark, d).select("key", F.to_json("payload").alias("json"))
    parsed = text.select("key", F.from_json("json", reports.PAYLOAD).alias("raw"))
    return parsed.select("key", reports.normalise(F.col("raw")).alias("payload"))


@query("alias_normalize", sql(f"""SELECT k AS key, {_BIRTH} AS birth_date, CASE WHEN k % 3 <> 0 THEN seg END AS employer,
  CASE WHEN k % 11 <> 0 THEN 'GHA-' || k END AS national_id, coalesce(codes, '') AS codes, coalesce(arrears, '') AS arrears
FROM keys LEFT JOIN (SELECT k, string_agg(code, ',' ORDER BY i) AS codes, string_agg(arrears, ',' ORDER BY i) AS arrears FROM agr GROUP BY 1) USING (k)
WHERE has_full""", **_CTE))
def alias_normalize(spark, d):
    full = F.col("payload.consumer_full_report_45")
    agreements = full["creditAgreementSummary"]
    return _normal(spark, d).filter(full["response"]["statusCode"].isNotNull()).select(
        "key", full["personalDetailsSummary"]["birthDate"].alias("birth_date"),
        full["personalDetailsSummary"]["employerDetail"].alias("employer"),
        full["personalDetailsSummary"]["nationalIDNo"].alias("national_id"),
        F.array_join(F.transform(agreements, lambda a: a["accountStatusCode"]), ",").alias("codes"),
        F.array_join(F.transform(agreements, lambda a: a["monthsInArrears"]), ",").alias("arrears"))


_LATEST = """SELECT k, code, arrears, opening, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY
  coalesce(opened, closed) DESC NULLS LAST, CASE WHEN coalesce(opened, closed) IS NULL THEN -i ELSE i END) AS rn FROM agr) WHERE rn = 1"""


@query("latest_element", sql("SELECT k AS key, code, CAST(arrears AS VARCHAR) AS arrears FROM latest", latest=_LATEST, **_CTE))
def latest_element(spark, d):
    agreements = F.col("payload.consumer_full_report_45.creditAgreementSummary")
    latest = reports.latest_element(agreements, list(reports.AGREEMENT_ALIASES))
    return _normal(spark, d).filter(F.size(agreements) > 0).select(
        "key", latest["accountStatusCode"].alias("code"), latest["monthsInArrears"].alias("arrears"))


_FLAT = {
    "consumer_full_report_45.response.statusCode": "status_45",
    "consumer_mobile_report_49.response.statusCode": "status_49",
    "consumer_full_report_45.personalDetailsSummary.birthDate": "birth_date",
    "consumer_full_report_45.creditAgreementSummary.accountStatusCode": "code",
    "consumer_full_report_45.creditAgreementSummary.monthsInArrears": "arrears",
    "consumer_full_report_45.creditAgreementSummary.openingBalanceAmt": "opening",
    "consumer_full_report_45.judgementSummary": "judgement",
}


@query("flatten_report", sql(f"""SELECT k AS key, CASE WHEN has_full THEN CASE WHEN hit THEN 200 ELSE 404 END END AS status_45,
  CASE WHEN mobile THEN 200 END AS status_49, CASE WHEN has_full THEN {_BIRTH} END AS birth_date, code,
  CAST(arrears AS VARCHAR) AS arrears, opening AS opening,
  CASE WHEN has_full AND k % 5 <> 0 AND k % 23 = 1 THEN 'judgement' END AS judgement
FROM keys LEFT JOIN latest USING (k)""", latest=_LATEST, **_CTE))
def flatten_report(spark, d):
    flat = reports.flatten(_normal(spark, d), "payload")
    return flat.select("key", *[
        (parse.number_or_null(reports.quoted(n)) if a == "opening" else reports.quoted(n)).alias(a) for n, a in _FLAT.items()])


@query("p45_extract", sql(f"""SELECT k AS key, {_BIRTH} AS birth_date, CAST(k % 7 AS DOUBLE) AS dependants, k % 3 <> 0 AS has_employer_detail,
  k % 11 <> 0 AS has_national_id_input, CASE WHEN k % 9 <> 0 THEN k % 5 ELSE 0 END + 0e0 AS highest_delinquency_rating_raw,
  k % 9 <> 0 AS has_highest_delinquency_input, (k * 97) % 200000 + 0.5e0 AS total_outstanding_debt_ghs,
  (k * 13) % 20000 + 0.5e0 AS total_monthly_instalment_ghs, k % 8 + 0e0 AS num_active_accounts, k % 12 + 0e0 AS num_accounts_total,
  CASE WHEN k % 6 <> 0 THEN k % 4 ELSE 0 END + 0e0 AS total_account_in_arrear_ghs, k % 6 <> 0 AS has_total_account_in_arrear_input,
  (k * 11) % 12000 + 0.5e0 AS total_arrear_amount_ghs, CASE WHEN k % 3 <> 0 THEN k % 3 ELSE 2 END AS num_bounced_cheques,
  k % 5 <> 0 AND k % 23 = 1 AS has_judgement, k % 5 <> 0 AS has_judgement_input, k % 31 = 2 AS has_adverse_default
FROM keys WHERE hit""", **_CTE))
def p45_extract(spark, d):
    full = F.col("payload.consumer_full_report_45")
    wanted = ["birth_date", "dependants", "has_employer_detail", "has_national_id_input", "highest_delinquency_rating_raw",
              "has_highest_delinquency_input", "total_outstanding_debt_ghs", "total_monthly_instalment_ghs",
              "num_active_accounts", "num_accounts_total", "total_account_in_arrear_ghs",
              "has_total_account_in_arrear_input", "total_arrear_amount_ghs", "num_bounced_cheques", "has_judgement",
              "has_judgement_input", "has_adverse_default"]
    fields = reports.extract_45(full)
    return _normal(spark, d).filter(reports.present(full)).select("key", *[fields[n].alias(n) for n in wanted])


@query("p49_extract", sql("""SELECT k AS key, CAST(k % 3 + 1 AS INTEGER) AS mobile_loan_history_count, (k * 19) % 7000 + 0.5e0 AS mobile_max_loan_ghs,
  (k * 23) % 9000 + 0.5e0 AS mobile_total_outstanding_ghs, (k * 29) % 900 + 0.5e0 AS mobile_total_monthly_instalment_ghs
FROM keys WHERE mobile""", **_CTE))
def p49_extract(spark, d):
    mobile = F.col("payload.consumer_mobile_report_49")
    return _normal(spark, d).filter(reports.present(mobile)).select(
        "key", *[v.alias(n) for n, v in reports.extract_49(mobile).items()])


@query("thin_file_overrides", sql("""SELECT k AS key, CASE WHEN thin THEN k % 7 + 0e0 END AS thin_dependants,
  CASE WHEN thin THEN k % 3 <> 0 END AS thin_has_employer,
  CASE WHEN thin THEN CASE WHEN k % 9 <> 0 THEN k % 5 ELSE 0 END + 0e0 END AS thin_rating
FROM (SELECT *, mobile AND NOT hit AS thin FROM keys)""", **_CTE))
def thin_file_overrides(spark, d):
    return _normal(spark, d).select("key", *[v.alias(n) for n, v in reports.thin_file_overrides(F.col("payload")).items()])


@query("unflatten_report", sql(f"""SELECT k AS key, CASE WHEN hit THEN {_BIRTH} END AS birth_date, CASE WHEN hit THEN code END AS code,
  CASE WHEN hit THEN CASE WHEN k % 5 <> 0 AND k % 23 = 1 THEN 1 ELSE 0 END END AS judgements,
  CASE WHEN mobile THEN (k * 19) % 7000 + 0.5e0 END AS highest_amount
FROM keys LEFT JOIN latest USING (k)""", latest=_LATEST, **_CTE))
def unflatten_report(spark, d):
    nested = reports.unflatten(reports.flatten(_normal(spark, d), "payload"), ["key"])
    full, mobile = F.col("payload.consumer_full_report_45"), F.col("payload.consumer_mobile_report_49")
    return nested.select(
        "key", full["personalDetailsSummary"]["birthDate"].alias("birth_date"),
        F.get(full["creditAgreementSummary"], F.lit(0))["accountStatusCode"].alias("code"),
        F.size(full["judgementSummary"]).alias("judgements"),
        parse.number_or_null(mobile["creditAccountSummary"]["highestAmountTaken"]).alias("highest_amount"))


def _flat(spark, d, names):
    """Some columns of the flat rows, stored: conditions that name a column often would find its latest element each time anew."""
    flat = reports.flatten(_normal(spark, d), "payload")
    return scratch.written(flat.select("key", *[reports.quoted(n) for n in names]), "flat-rows")


@query("contract_flat_rows", sql("""SELECT coalesce(error, 'ok') AS outcome, count(*) AS n FROM (
  SELECT CASE WHEN hit AND k % 4 = 0 THEN 'missing: ' || concat_ws(',', 'consumer_full_report_45.creditAgreementSummary.accountStatusCode',
      'consumer_full_report_45.creditAgreementSummary.monthsInArrears', 'consumer_full_report_45.creditAgreementSummary.openingBalanceAmt')
    WHEN NOT hit AND NOT mobile THEN 'no product 45 and no product 49' END AS error FROM keys) GROUP BY 1""", **_CTE))
def contract_flat_rows(spark, d):
    flat = _flat(spark, d, [*reports.REQUIRED_FLAT, "consumer_mobile_report_49.response.statusCode"])
    errors = reports.flat_contract_errors(flat)
    return flat.groupBy(F.coalesce(errors, F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("restore_required", sql("""SELECT k AS key, CASE WHEN hit OR k % 2 = 0 THEN code ELSE '' END AS code,
  CASE WHEN hit OR k % 2 = 0 THEN CAST(arrears AS VARCHAR) END AS arrears FROM keys JOIN latest USING (k)""",
                             latest=_LATEST, **_CTE))
def restore_required(spark, d):
    """Masking blanks two agreement fields on odd keys; full-report rows get them back."""
    flat = _flat(spark, d, reports.REQUIRED_FLAT).filter(reports.quoted(reports.REQUIRED_FLAT[1]).isNotNull())
    code, arrears = reports.REQUIRED_FLAT[1], reports.REQUIRED_FLAT[2]
    odd = F.col("key") % 2 == 1
    both = flat.select("key", *[reports.quoted(n).alias(f"original:{n}") for n in reports.REQUIRED_FLAT],
                       *[reports.quoted(n) for n in (reports.REQUIRED_FLAT[0], reports.REQUIRED_FLAT[3])],
                       F.when(odd, F.lit("")).otherwise(reports.quoted(code)).alias(code),
                       F.when(~odd, reports.quoted(arrears)).alias(arrears))
    fixed = reports.restore_required(both, "original:")
    return both.select("key", fixed[code].alias("code"), fixed[arrears].alias("arrears"))


@query("report_decisions")
def report_decisions(spark, d):
    """The nested path end to end: JSON text to decision, without a shuffle."""
    normal = _normal(spark, d).withColumn("request_id", F.concat(F.lit("REQ-"), "key")).drop("key")
    facts = reports.facts(normal)
    scored = features.score(features.feature_vector(facts))
    return scored.select("request_id", "hit_status", "hard_stop_code", "credit_score", "score_grade", "decision",
                         F.array_join("decision_reason_codes", ",").alias("decision_reason_codes"))


# --- batch lines -----------------------------------------------------------------------------------------


def _lines(spark, d):
    return reports.parse_lines(source.lines(spark, d))


@query("jsonl_partial", sql("""SELECT k + 1 AS line_no, CASE WHEN k % 6 = 4 THEN 'Line ' || (k + 1) || ': invalid JSON' END AS error,
  CASE WHEN k % 6 = 4 THEN NULL WHEN k % 6 = 3 THEN CASE WHEN mobile THEN 'THIN_FILE' ELSE 'NO_RECORD' END
    WHEN k % 6 = 2 THEN CASE WHEN hit THEN 'HIT' ELSE 'NO_RECORD' END
    WHEN hit THEN 'HIT' WHEN mobile THEN 'THIN_FILE' ELSE 'NO_RECORD' END AS hit_status FROM keys""", **_CTE))
def jsonl_partial(spark, d):
    """Good and bad lines in one report: a bad line carries its error and never fails the batch."""
    status = reports.hit_status(reports.payload_of(F.col("obj")))
    return _lines(spark, d).select("line_no", "error", F.when(F.col("error").isNull(), status).alias("hit_status"))


@query("payload_shape", sql("""SELECT shape, count(*) AS n FROM (SELECT CASE WHEN k % 6 IN (0, 5) THEN 'wrapped'
  WHEN k % 6 = 1 AND (has_full OR mobile) THEN 'reports' WHEN k % 6 = 3 AND mobile THEN 'bare_49' ELSE 'bare_45' END AS shape
  FROM keys WHERE k % 6 <> 4) GROUP BY 1""", **_CTE))
def payload_shape(spark, d):
    return _lines(spark, d).filter("error is null").groupBy(reports.shape(F.col("obj")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"))


@query("request_ids", sql("""SELECT k + 1 AS line_no, CASE WHEN k % 6 IN (0, 1) THEN 'REQ-' || k
  WHEN (k % 6 = 2 AND has_full) OR (k % 6 = 3 AND mobile) OR (k % 6 = 5 AND (has_full OR mobile)) THEN 'inference-C' || k
  ELSE 'inference-batch-L' || (k + 1) || '-' || substr(sha256(CASE WHEN k % 6 = 5 THEN '{"xds_payload":{}}' ELSE '{}' END), 1, 12) END AS request_id
FROM keys WHERE k % 6 <> 4""", **_CTE))
def request_ids(spark, d):
    return _lines(spark, d).filter("error is null").select(
        "line_no", reports.request_id(F.col("obj"), F.col("line"), F.col("line_no")).alias("request_id"))


@query("id_style_uniform", sql("""SELECT count(*) AS lines, count(*) FILTER (k % 6 IN (0, 1)) AS with_id, false AS uniform
FROM keys WHERE k % 6 <> 4""", **_CTE))
def id_style_uniform(spark, d):
    ids = _lines(spark, d).filter("error is null").select(F.col("obj.request_id").alias("request_id"))
    return batches.id_style(ids)


def applicant_lines(spark, d):
    """Batch-scoring lines from customers: every defect occurs by key."""
    key = F.col("c_custkey")
    pairs = [F.struct(F.lit(n).alias("key"), (key % (i + 7) / F.lit(100.0)).alias("value")) for i, n in enumerate(catalog.FEATURES)]
    entries = F.array(*pairs)
    entries = F.when(key % 13 == 0, F.slice(entries, 2, 29)).otherwise(entries)
    entries = F.when(key % 17 == 0, F.concat(entries, F.array(F.struct(F.lit("bonus").alias("key"), F.lit(1.0).alias("value"))))).otherwise(entries)
    entries = F.when(key % 19 == 0, F.transform(entries, lambda e: F.struct(e["key"].alias("key"), F.when(
        e["key"] != "applicant_age", e["value"]).alias("value")))).otherwise(entries)
    return table(spark, d, "customer").select(
        (key + 1).alias("line_no"),
        F.when(key % 23 != 0, F.concat(F.lit("APP-"), key - F.when(key % 29 == 5, F.lit(1)).otherwise(0))).alias("request_id"),
        F.when(key % 37 != 3, F.map_from_entries(entries)).alias("features"),
        F.when(key % 31 != 4, F.struct(
            F.when(key % 41 != 6, F.lit("bank-1")).alias("data_source_id"),
            F.when(key % 43 != 7, F.lit("core")).alias("source_system"))).alias("metadata"))


_DUP = "(k % 29 = 5 OR k % 29 = 4)"


@query("batch_applicants", sql("""SELECT k + 1 AS line_no, CASE WHEN k % 23 = 0 THEN 'request_id is required'
  WHEN copies > 1 THEN 'duplicate request_id ' || rid WHEN k % 37 = 3 THEN 'features must be an object'
  WHEN k % 13 = 0 OR k % 17 = 0 THEN 'keys mismatch; missing: ' || CASE WHEN k % 13 = 0 THEN 'highest_delinquency_rating' ELSE '' END
    || '; extra: ' || CASE WHEN k % 17 = 0 THEN 'bonus' ELSE '' END
  WHEN k % 19 = 0 THEN 'null features: applicant_age' WHEN k % 31 = 4 THEN 'metadata must be an object'
  WHEN k % 41 = 6 THEN 'metadata.data_source_id is required' WHEN k % 43 = 7 THEN 'metadata.source_system is required' END AS error
FROM (SELECT *, count(*) OVER (PARTITION BY rid) AS copies FROM (SELECT k,
  CASE WHEN k % 23 <> 0 THEN 'APP-' || (k - CASE WHEN k % 29 = 5 THEN 1 ELSE 0 END) END AS rid FROM keys))""", **_CTE))
def batch_applicants(spark, d):
    rows = batches.with_copies(applicant_lines(spark, d))
    error = batches.applicant_errors(
        F.col("request_id"), F.col("copies"), F.col("features"), F.col("metadata"))
    return rows.select("line_no", error.alias("error"))


@query("batch_guard", sql("""SELECT batch, count(*) AS lines, count(*) <= 100 AS accepted FROM (SELECT k % 12 AS batch FROM keys) GROUP BY 1""", **_CTE))
def batch_guard(spark, d, limit: int = 100):
    """Which upload batches are small enough for the synchronous route."""
    return source.lines(spark, d).groupBy((F.col("key") % 12).alias("batch")).agg(
        F.count(F.lit(1)).alias("lines"), (F.count(F.lit(1)) <= limit).alias("accepted"))


@query("feature_key_diff", sql("SELECT k + 1 AS line_no, CASE WHEN k % 37 = 3 THEN '" + ",".join(sorted(FEATURE_NAMES)) + """' WHEN k % 13 = 0 THEN 'highest_delinquency_rating' ELSE '' END AS missing,
  CASE WHEN k % 17 = 0 AND k % 37 <> 3 THEN 'bonus' ELSE '' END AS extra FROM keys""", **_CTE))
def feature_key_diff(spark, d):
    """A line without features misses all of them."""
    missing, extra = batches.key_difference(F.coalesce("features", F.create_map().cast("map<string,double>")))
    return applicant_lines(spark, d).select(
        "line_no", F.array_join(missing, ",").alias("missing"), F.array_join(extra, ",").alias("extra"))


_REQ = [n for n in FEATURE_NAMES if n in catalog.REQUIRED_FEATURES]


@query("validate_inference", sql("""SELECT k + 1 AS line_no, concat_ws('; ',
  CASE WHEN k % 37 = 3 THEN 'features missing' WHEN k % 13 = 0 THEN 'missing highest_delinquency_rating' END,
  CASE WHEN k % 19 = 0 AND k % 37 <> 3 THEN 'null applicant_age' END) AS errors FROM keys""", **_CTE))
def validate_inference(spark, d):
    """Every name must be there; only imputable ones may be null or NaN. Lines without features are reported as such."""
    values = F.col("features")
    missing, _ = batches.key_difference(values)
    null = F.array_compact(F.array(*[
        F.when(F.map_contains_key(values, n) & (values[n].isNull() | F.isnan(values[n])), F.lit(n)) for n in _REQ]))
    parts = F.concat(F.transform(missing, lambda m: F.concat(F.lit("missing "), m)),
                     F.transform(null, lambda m: F.concat(F.lit("null "), m)))
    errors = F.when(values.isNull(), F.lit("features missing")).otherwise(F.array_join(parts, "; "))
    return applicant_lines(spark, d).select("line_no", errors.alias("errors"))


@query("model_subset", sql("""SELECT k AS key, CASE k % 6 WHEN 0 THEN 'credit_risk,fraud_detection,loan_amount,income_verification'
  WHEN 1 THEN 'credit_risk,loan_amount' WHEN 2 THEN 'income_verification' WHEN 3 THEN ''
  WHEN 4 THEN 'credit_risk,fraud_detection,loan_amount,income_verification' ELSE 'fraud_detection' END AS models FROM keys""", **_CTE))
def model_subset(spark, d):
    # What callers send, by key % 6.
    raw = F.element_at(F.array(F.lit("all"), F.lit("credit_risk, loan_amount"), F.lit('["income_verification", "weather"]'),
                               F.lit("weather"), F.lit(""), F.lit(" fraud_detection ,x")), (F.col("c_custkey") % 6 + 1).cast("int"))
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.array_join(batches.model_subset(raw), ",").alias("models"))


# --- messages and paths ------------------------------------------------------------------------------------


def messages(spark, d):
    """Hand-off messages from events; fields go missing by id."""
    ev = F.col("event_id")
    sub = F.element_at(F.array(*[F.lit(s) for s in (
        "start-transformation", "quality_report", "transformed", "analysis-complete", "failed", "mapping-complete", "other")]),
        (ev % 7 + 1).cast("int"))
    bank, upload = F.concat(F.lit("bank-"), F.col("user_id")), F.concat(F.lit("upload-0000-"), ev)
    name = F.concat(F.lit("bronze/training/"), bank, F.lit("/"), F.date_format("ts", "yyyy-MM-dd"), F.lit("/"), upload)
    return table(spark, d, "events").select(
        ev.alias("event_id"), sub.alias("subscription"), F.when(ev % 11 != 0, F.concat(F.lit("run-"), ev)).alias("run_id"),
        F.when(ev % 13 != 0, F.when(ev % 17 != 0, upload).otherwise("u-1")).alias("training_upload_id"),
        F.when(ev % 19 != 0, F.when(ev % 23 != 0, bank).otherwise("  ")).alias("bank_id"),
        F.when(ev % 29 != 0, F.when(ev % 31 != 0, F.concat(name, F.when(ev % 3 == 0, F.lit(".CSV")).when(ev % 3 == 1, F.lit(".json"))
                                                           .otherwise(""))).otherwise(F.concat(F.lit("raw/"), upload))).alias("bronze_blob_path"),
        F.when(ev % 5 == 0, F.lit("csv")).when(ev % 5 == 1, F.lit(".parquet")).alias("file_format"),
        F.when(ev % 7 == 2, F.lit("TRANSFORMED")).when(ev % 7 == 5, F.lit("MAPPING_COMPLETE")).when(ev % 37 == 0, F.lit("ERROR")).alias("status"),
        F.when((ev % 7 == 2) & (ev % 2 == 0), F.lit("gold/x")).alias("transformed_file_path"),
        F.when(ev % 41 == 0, F.lit("{}")).alias("quality_report"), F.when(ev % 43 == 0, F.lit("ADF")).alias("processing_system"))


_MSG = """SELECT event_id AS e, ts, user_id, (['start-transformation','quality_report','transformed','analysis-complete','failed','mapping-complete','other'])[event_id % 7 + 1] AS sub,
  event_id % 11 <> 0 AS run, event_id % 13 <> 0 AS upload, event_id % 19 <> 0 AS bank, event_id % 29 <> 0 AS path,
  CASE WHEN event_id % 7 = 2 THEN 'TRANSFORMED' WHEN event_id % 7 = 5 THEN 'MAPPING_COMPLETE' WHEN event_id % 37 = 0 THEN 'ERROR' END AS status,
  event_id % 7 = 2 AND event_id % 2 = 0 AS transformed FROM events"""
_PATH = """SELECT *, CASE WHEN NOT path THEN NULL WHEN e % 31 = 0 THEN 'raw/upload-0000-' || e
  ELSE 'training/bank-' || user_id || '/' || strftime(ts, '%Y-%m-%d') || '/upload-0000-' || e || CASE e % 3 WHEN 0 THEN '.CSV' WHEN 1 THEN '.json' ELSE '' END END AS p FROM msg"""


@query("route_messages", sql("""SELECT coalesce(route, 'none') AS route, trigger, count(*) AS n FROM (SELECT CASE
  WHEN e % 43 = 0 THEN 'adf-trigger-subscription' WHEN run AND sub = 'quality_report' THEN 'quality_report'
  WHEN sub = 'start-transformation' AND run AND upload AND bank AND path AND coalesce(status, '') <> 'ERROR' THEN 'start-transformation'
  WHEN sub = 'transformed' AND status = 'TRANSFORMED' AND run AND transformed THEN 'transformed'
  WHEN run AND sub = 'failed' THEN 'failed' WHEN status = 'MAPPING_COMPLETE' AND sub = 'mapping-complete' THEN 'mapping-complete'
  WHEN run AND upload AND sub = 'analysis-complete' THEN sub END AS route,
  NOT transformed AND e % 41 <> 0 AND path AND bank AND e % 23 <> 0 AND upload AS trigger FROM msg) GROUP BY 1, 2""", msg=_MSG))
def route_messages(spark, d):
    return messages(spark, d).groupBy(
        F.coalesce(batches.route(), F.lit("none")).alias("route"), batches.is_mapping_trigger().alias("trigger")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("event_validate", sql("""SELECT e AS event_id, concat_ws(',', CASE WHEN NOT upload THEN 'training_upload_id' END,
  CASE WHEN NOT bank OR e % 23 = 0 THEN 'bank_id' END, CASE WHEN NOT path THEN 'bronze_blob_path' END,
  CASE WHEN path AND e % 31 = 0 THEN 'path_prefix' END, CASE WHEN upload AND e % 17 = 0 THEN 'upload_id_length' END,
  CASE WHEN path AND e % 31 = 0 THEN 'path_date' END) AS errors FROM msg""", msg=_MSG))
def event_validate(spark, d):
    return messages(spark, d).select("event_id", F.array_join(batches.event_errors(), ",").alias("errors"))


@query("path_metadata", sql("""SELECT e AS event_id, aligned AS path, CASE WHEN e % 31 <> 0 THEN 'bank-' || user_id END AS path_bank,
  CASE WHEN e % 31 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS path_date, CASE WHEN e % 31 <> 0 THEN 'upload-0000-' || e END AS path_upload,
  CASE WHEN e % 31 <> 0 THEN CASE WHEN fmt IS NOT NULL AND lower(ext) <> fmt THEN fmt ELSE ext END END AS path_format
FROM (SELECT *, CASE WHEN fmt IS NULL OR lower(ext) = fmt THEN p ELSE (CASE WHEN ext = '' THEN p ELSE substr(p, 1, length(p) - length(ext) - 1) END) || '.' || fmt END AS aligned
  FROM (SELECT *, CASE e % 5 WHEN 0 THEN 'csv' WHEN 1 THEN 'parquet' END AS fmt,
    CASE WHEN e % 31 = 0 THEN '' ELSE CASE e % 3 WHEN 0 THEN 'CSV' WHEN 1 THEN 'json' ELSE '' END END AS ext FROM path WHERE p IS NOT NULL))""", msg=_MSG, path=_PATH))
def path_metadata(spark, d):
    path = batches.align_extension(batches.clean_path(F.col("bronze_blob_path")), F.col("file_format"))
    aligned = messages(spark, d).filter("bronze_blob_path is not null").select("event_id", path.alias("path"))
    return aligned.select("event_id", "path", *[c.alias(n) for n, c in batches.path_parts(F.col("path")).items()])


@query("error_codes", sql("SELECT event_id, error_code, CASE error_code " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in batches.ERROR_TEXT.items()) + """ END AS user_text FROM (SELECT e AS event_id, CASE e % 8
  WHEN 0 THEN CASE WHEN e % 3 = 0 THEN 'SCHEMA_DETECTION_FAILED' ELSE 'INTROSPECTION_FAILED' END
  WHEN 1 THEN 'SCHEMA_DETECTION_FAILED' WHEN 2 THEN 'DATA_SAMPLING_FAILED' WHEN 3 THEN 'DATA_ANALYSIS_FAILED'
  WHEN 4 THEN CASE WHEN e % 3 = 2 THEN 'PII_DETECTION_FAILED' ELSE 'ANONYMIZATION_FAILED' END WHEN 5 THEN 'SCHEMA_MAPPING_FAILED'
  ELSE CASE WHEN e % 2 = 0 THEN 'CONNECTION_ERROR' WHEN e % 3 = 1 THEN 'STORAGE_ERROR' WHEN e % 5 = 0 THEN 'VALIDATION_ERROR' ELSE 'UNKNOWN_ERROR' END END AS error_code
FROM msg)""", msg=_MSG))
def error_codes(spark, d):
    ev = F.col("event_id")
    # Systems and messages by event id.
    system = F.element_at(F.array(*[F.lit(s) for s in (
        "System 0: File Introspection", "System 1", "Data Sampling", "System 3", "System 4: PII", "Schema Mapping", "Writer", "Writer")]),
        (ev % 8 + 1).cast("int"))
    message = F.element_at(F.array(F.lit("Bad file format"), F.lit("Blob not found"), F.lit("Detection stopped")), (ev % 3 + 1).cast("int"))
    kind = F.when(ev % 2 == 0, F.lit("ConnectionError")).when(ev % 5 == 0, F.lit("KeyError")).otherwise("RuntimeError")
    code = batches.error_code(kind, message, system)
    return table(spark, d, "events").select("event_id", code.alias("error_code"), batches.error_text(code).alias("user_text"))
