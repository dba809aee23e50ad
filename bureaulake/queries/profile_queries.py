"""Queries: profiling, quality, sampling, personal data, internal schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake.catalog import AsOf
from bureaulake.functions import parse
from bureaulake.functions.bins import case
from bureaulake.operators import privacy, profile, ranking
from bureaulake.queries.ctes import sql
from bureaulake.sources import detect, files, scratch, views
from bureaulake.sources.views import spread, table

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def upload(spark, d):
    """An uploaded customer file with gaps, money text and dates in two layouts."""
    key = F.col("c_custkey")
    signup = F.date_add(F.lit("2019-01-01").cast("date"), (key * 17 % 1500).cast("int"))
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"]
    return spread(table(spark, d, "customer").select(*columns), "upload-customers").select(
        key.alias("customer_id"), F.when(key % 9 != 0, F.col("c_name")).alias("full_name"),
        F.when(key % 10 != 0, F.concat(F.lit("user"), key, F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("0244"), F.lpad((key % 1000000).cast("string"), 6, "0")).alias("phone_number"),
        F.when(key % 4 != 0, F.concat(F.format_number(key * 1009 % 90000, 0), F.lit(".25"))).alias("amount_text"),
        F.when(key % 5 == 0, F.date_format(signup, "dd/MM/yyyy")).otherwise(F.date_format(signup, "yyyy-MM-dd")).alias("signup_date"),
        F.col("c_mktsegment").alias("segment"), F.when(key % 13 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_nationkey").alias("nation"))


_UP = """SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS full_name,
  CASE WHEN c_custkey % 10 <> 0 THEN 'user' || c_custkey || '@example.com' END AS email, '0244' || lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS phone_number,
  CASE WHEN c_custkey % 4 <> 0 THEN format('{:,}', c_custkey * 1009 % 90000) || '.25' END AS amount_text,
  CASE WHEN c_custkey % 5 = 0 THEN strftime(DATE '2019-01-01' + CAST(c_custkey * 17 % 1500 AS INTEGER), '%d/%m/%Y')
    ELSE strftime(DATE '2019-01-01' + CAST(c_custkey * 17 % 1500 AS INTEGER), '%Y-%m-%d') END AS signup_date,
  c_mktsegment AS segment, CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS balance, c_nationkey AS nation FROM customer"""
_COLUMNS = ["customer_id", "full_name", "email", "phone_number", "amount_text", "signup_date", "segment", "balance", "nation"]
_TEXTS = ["full_name", "email", "phone_number", "amount_text", "signup_date", "segment"]


def _each(template, columns=_COLUMNS):
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


_MISSING = _each("SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, round(count({c}) * 100e0 / count(*), 2) AS completeness_pct, count(*) AS total_rows, "
                 "CASE WHEN count({c}) = count(*) THEN 'complete' WHEN count({c}) > 0 THEN 'random' ELSE 'all_null' END AS pattern FROM up")


@query("profile_missing", sql("SELECT * FROM miss", miss=_MISSING, up=_UP))
def profile_missing(spark, d):
    return profile.missing(upload(spark, d))


_DIST = _each("SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, round(median(CAST({c} AS DOUBLE)), 6) AS median, "
              "round(coalesce(stddev_samp({c}), 0), 4) AS std, count(DISTINCT {c}) AS unique_count FROM up", ["customer_id", "balance", "nation"])


@query("profile_distribution", sql("SELECT * FROM dist", dist=_DIST, up=_UP))
def profile_distribution(spark, d):
    return profile.distribution(upload(spark, d)).select(
        "column", "min", "max", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), F.round("std", 4).alias("std"), "unique_count")


@query("zscore_outliers", """SELECT 'value' AS "column", event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) WHERE abs((value - m) / s) > 1.96
  UNION ALL SELECT 'user_id', event_id, CAST(user_id AS DOUBLE) FROM events, (SELECT avg(user_id) AS m, stddev_samp(user_id) AS s FROM events) WHERE abs((user_id - m) / s) > 1.96""")
def zscore_outliers(spark, d):
    return profile.outliers(table(spark, d, "events").select("event_id", "user_id", "value"), "event_id")


@query("profile_examples", sql("""SELECT "column", string_agg(value, '|' ORDER BY d) AS examples FROM (
  SELECT "column", value[1:50] AS value, d, row_number() OVER (PARTITION BY "column" ORDER BY d) AS rn FROM (SELECT DISTINCT "column", value, md5(value) AS d FROM ("""
    + _each("SELECT '{c}' AS \"column\", {c} AS value FROM up WHERE {c} IS NOT NULL", ["full_name", "email", "phone_number", "amount_text", "signup_date", "segment"])
    + """))) WHERE rn <= 3 GROUP BY 1""", up=_UP))
def profile_examples(spark, d):
    """Three different values of each text column."""
    return profile.examples(upload(spark, d), _TEXTS).select("column", F.array_join("examples", "|").alias("examples"))


@query("profile_types", sql(_each(
    "SELECT '{c}' AS \"column\", CASE WHEN bool_and(regexp_matches(trim(CAST({c} AS VARCHAR)), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')) "
    "THEN 'string_numeric' ELSE 'string' END AS type FROM up", _TEXTS) + " UNION ALL VALUES ('customer_id', 'integer'), ('nation', 'integer'), ('balance', 'float')", up=_UP))
def profile_types(spark, d):
    return profile.logical_types(upload(spark, d))


_TYPES = "VALUES ('amount_text', 'string'), ('balance', 'float'), ('customer_id', 'integer'), ('email', 'string'), ('full_name', 'string'), ('nation', 'integer'), ('phone_number', 'string_numeric'), ('segment', 'string'), ('signup_date', 'string')"


@query("schema_hash", sql("SELECT sha256(string_agg(c || ':' || t, '|' ORDER BY c)) AS schema_hash FROM types", types=f"SELECT * FROM ({_TYPES}) v(c, t)"))
def schema_hash(spark, d):
    return profile.schema_hash(profile_types(spark, d))


_FMT = _each("""SELECT '{c}' AS "column", CASE WHEN dates > n / 2e0 THEN 'date' WHEN numbers = n THEN 'number' ELSE 'text' END AS format_type,
  numbers = n AND NOT dates > n / 2e0 AND has_comma AS thousands, numbers = n AND NOT dates > n / 2e0 AND has_dot AS decimals, numbers = n AND NOT dates > n / 2e0 AND cur AS currency
FROM (SELECT count({c}) AS n, count(*) FILTER (regexp_full_match({c}, '\\d{4}-\\d{2}-\\d{2}|\\d{2}/\\d{2}/\\d{4}')) AS dates,
  count(*) FILTER (regexp_full_match(replace({c}, ',', ''), '[+-]?\\d+(\\.\\d+)?')) AS numbers, bool_or(contains({c}, ',')) AS has_comma, bool_or(contains({c}, '.')) AS has_dot,
  bool_or(contains({c}, '$') OR contains({c}, 'GHS')) AS cur FROM up)""", _TEXTS)


@query("profile_formats", sql(_FMT + " UNION ALL SELECT c, 'number', false, false, false FROM (VALUES ('customer_id'), ('balance'), ('nation')) v(c)", up=_UP))
def profile_formats(spark, d):
    return profile.value_formats(upload(spark, d))


_SHAPES = [("EMAIL", "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$"), ("PHONE", "^[\\+]?[(]?[0-9]{1,4}[)]?[-\\s\\.]?[(]?[0-9]{1,4}[)]?[-\\s\\.]?[0-9]{1,9}$"),
           ("UUID", "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), ("GUID", "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
           ("NATIONAL_ID", "^[A-Z0-9]{6,20}$"), ("CREDIT_CARD", "^[0-9]{13,19}$"), ("ALPHANUMERIC", "^[A-Za-z0-9]+$"), ("NUMERIC", "^[0-9]+$"),
           ("DATE_STRING", "^\\d{4}[-/]\\d{1,2}[-/]\\d{1,2}")]
_SHARES = ", ".join(f"count(*) FILTER (regexp_matches(trim({{c}}), '{p}')) AS p{i}" for i, (_, p) in enumerate(_SHAPES))
_NAMED = "concat_ws(',', " + ", ".join(f"CASE WHEN p{i} > n * 0.5 THEN '{n}' END" for i, (n, _) in enumerate(_SHAPES)) + ")"


@query("text_patterns", sql("SELECT \"column\", CASE WHEN named <> '' THEN named WHEN sep >= n * 0.5 THEN 'ALPHANUMERIC_WITH_SEPARATORS' WHEN d / n > 0.9 THEN 'UNIQUE_TEXT' ELSE 'TEXT' END AS patterns FROM (SELECT *, "
                            + _NAMED + " AS named FROM shares)", up=_UP, shares=_each(
    "SELECT '{c}' AS \"column\", count({c}) AS n, count(DISTINCT {c}) AS d, count(*) FILTER (regexp_matches(trim({c}), '^[A-Za-z0-9_-]+$')) AS sep, " + _SHARES + " FROM up", _TEXTS)))
def text_patterns(spark, d):
    return profile.text_patterns(upload(spark, d)).select("column", F.array_join("patterns", ",").alias("patterns"))


@query("date_formats", sql("""SELECT 'signup_date' AS "column", layout, count(*) AS n, round(count(*) / (SELECT count(*) FROM up)::DOUBLE, 4) AS confidence FROM (
  SELECT CASE WHEN contains(signup_date, '-') THEN 'ISO' WHEN CAST(substr(signup_date, 4, 2) AS INTEGER) <= 12 AND CAST(substr(signup_date, 1, 2) AS INTEGER) <= 12 THEN 'US_SLASH' ELSE 'EU_SLASH' END AS layout FROM up) GROUP BY 2""", up=_UP))
def date_formats(spark, d):
    df = upload(spark, d)
    return profile.date_formats(df, profile.text_columns(df))


@query("schema_detect", sql("SELECT *, true AS has_header, 0.9e0 AS confidence FROM (" + _each("""SELECT '{c}' AS "column", arg_min(kind, struct_pack(a := -n, b := kind)) AS type, CAST(sum(n) AS BIGINT) AS n, max(n) AS votes FROM (
  SELECT CASE WHEN regexp_matches({c}, '^[+-]?\\d+$') THEN 'integer' WHEN regexp_matches(replace({c}, ',', ''), '^[+-]?\\d*\\.?\\d+$') AND NOT contains({c}, ',') THEN 'float'
    WHEN regexp_matches({c}, '^(\\d{4}-\\d{2}-\\d{2}|\\d{2}/\\d{2}/\\d{4})$') THEN 'date' ELSE 'string' END AS kind, count(*) AS n FROM (SELECT CAST({c} AS VARCHAR) AS {c} FROM up) WHERE {c} IS NOT NULL GROUP BY 1)""") + ")", up=_UP))
def schema_detect(spark, d):
    """Header, majority type of every column and confidence of an uploaded csv, from its files alone."""
    path = scratch.folder(spark, "schema")
    upload(spark, d).select(*_COLUMNS).write.csv(path, header=True)
    return detect.schema(spark, path, "part-*")


# --- samples -------------------------------------------------------------------------------------------------


def _samples(spark, d, size=10_000):
    """Three samples without replacement by seeded hash, one table with ``sample_id``; a smaller table is in each as a whole."""
    df = upload(spark, d)
    parts = [ranking.hash_sample(df, F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(f"-{seed}"))), size)
             .withColumn("sample_id", F.lit(seed)) for seed in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_SAMPLES = " UNION ALL ".join(f"SELECT *, {i} AS sample_id FROM (SELECT * FROM up ORDER BY md5(customer_id || '-{i}') LIMIT 10000)" for i in (1, 2, 3))


@query("resamples", sql("SELECT sample_id, customer_id, email, balance FROM samples", samples=_SAMPLES, up=_UP))
def resamples(spark, d):
    return _samples(spark, d).select("sample_id", "customer_id", "email", "balance")


def _parts(spark, d, parts=3):
    """The whole table in three groups by hash, as ``sample_id``: together they hold every row once."""
    digest = F.conv(F.substring(F.md5(F.col("customer_id").cast("string")), 1, 6), 16, 10).cast("long")
    return upload(spark, d).withColumn("sample_id", (digest % parts).cast("int"))


_PARTS = "SELECT *, CAST(('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 6))::BIGINT % 3 AS INTEGER) AS sample_id FROM up"


@query("sample_stats", sql("""SELECT sample_id, count(*) AS n, count(balance) AS filled, round(avg(balance), 4) AS mean, min(balance) AS min, max(balance) AS max,
  (SELECT count(*) FROM shared) AS all_columns, (SELECT count(*) FROM shared WHERE n = (SELECT count(DISTINCT sample_id) FROM parts)) AS common_columns FROM parts GROUP BY 1""",
    shared='SELECT "column", count(*) AS n FROM (' + _each("SELECT '{c}' AS \"column\", sample_id FROM parts GROUP BY sample_id HAVING count({c}) > 0") + ') GROUP BY 1', parts=_PARTS, up=_UP))
def sample_stats(spark, d):
    rows = _parts(spark, d)
    present = rows.groupBy("sample_id").agg(F.array_compact(F.array(*[F.when(F.count(c) > 0, F.lit(c)) for c in _COLUMNS])).alias("present"))
    sets = profile.column_sets(present.select("sample_id", F.explode("present").alias("column")))
    stats = rows.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("balance").alias("filled"), F.round(F.avg("balance"), 4).alias("mean"),
        F.min("balance").alias("min"), F.max("balance").alias("max"))
    return stats.crossJoin(F.broadcast(sets))  # one row


_FILLED = _each("SELECT '{c}' AS \"column\", count({c}) AS n FROM parts GROUP BY sample_id")


@query("sample_types", sql("""SELECT "column", t AS types, count(*) FILTER (n > 0) AS samples, round(avg(n), 4) AS avg_filled, min(n) AS min_filled, max(n) AS max_filled
  FROM filled JOIN (""" + _TYPES.replace("VALUES", "SELECT * FROM (VALUES", 1) + """) v(c0, t)) ON c0 = "column" GROUP BY 1, 2""", filled=_FILLED, parts=_PARTS, up=_UP))
def sample_types(spark, d):
    """Types and numbers of values of each column over the three parts of a table."""
    found = profile.across(profile.grouped(_parts(spark, d), ["sample_id"]))
    return found.withColumn("avg_filled", F.round("avg_filled", 4))


_NAMED_PARTS = _each("SELECT '{c}' AS \"column\", sample_id, count({c}) AS n, count(DISTINCT {c}) AS d, count(*) FILTER (regexp_matches(trim({c}), '^[A-Za-z0-9_-]+$')) AS sep, " + _SHARES + " FROM parts GROUP BY sample_id", _TEXTS)
_PART_NUMBERS = _each("SELECT '{c}' AS \"column\", sample_id, round(count({c}) * 100e0 / count(*), 2) AS c, CAST(NULL AS DOUBLE) AS m, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi FROM parts GROUP BY sample_id", _TEXTS) + " UNION ALL " + _each(
    "SELECT '{c}', sample_id, round(count({c}) * 100e0 / count(*), 2), avg({c}), min({c}), max({c}) FROM parts GROUP BY sample_id", ["customer_id", "balance", "nation"])


@query("profile_merged", sql("""SELECT "column", t AS type, round(avg(c), 4) AS completeness_pct, round(avg(m), 4) AS mean, round(avg(lo), 4) AS min, round(avg(hi), 4) AS max, count(*) AS samples, coalesce(any_value(patterns), '') AS patterns
  FROM numbers JOIN (""" + _TYPES.replace("VALUES", "SELECT * FROM (VALUES", 1) + """) v(c0, t)) ON c0 = "column" LEFT JOIN united USING ("column") GROUP BY 1, 2""",
    numbers=_PART_NUMBERS, united="""SELECT "column", array_to_string(list_sort(list_distinct(flatten(list(string_split(p, ','))))), ',') AS patterns FROM (
  SELECT "column", CASE WHEN named <> '' THEN named WHEN sep >= n * 0.5 THEN 'ALPHANUMERIC_WITH_SEPARATORS' WHEN d / n > 0.9 THEN 'UNIQUE_TEXT' ELSE 'TEXT' END AS p
  FROM (SELECT *, """ + _NAMED + """ AS named FROM named_parts) WHERE n > 0) GROUP BY 1""", named_parts=_NAMED_PARTS, parts=_PARTS, up=_UP))
def profile_merged(spark, d):
    """Profiles of the table's three parts united into one row per column: types, numbers and the union of text patterns."""
    merged = profile.merged(profile.grouped(_parts(spark, d), ["sample_id"]))
    return merged.select("column", "type", *[F.round(n, 4).alias(n) for n in ("completeness_pct", "mean", "min", "max")], "samples", F.array_join("patterns", ",").alias("patterns"))


@query("split_stratified", """SELECT segment, split, count(*) AS n, min(key) AS first_key, max(key) AS last_key FROM (SELECT *, CASE WHEN rn <= floor(size * 0.70e0) THEN 'train'
  WHEN rn <= floor(size * (0.70e0 + 0.15e0)) THEN 'validation' ELSE 'holdout' END AS split FROM (SELECT c_mktsegment AS segment, c_custkey AS key,
  row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR))) AS rn, count(*) OVER (PARTITION BY c_mktsegment) AS size FROM customer)) GROUP BY 1, 2""")
def split_stratified(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("key"))
    labelled = ranking.split_labels(rows, ["segment"], F.md5(F.col("key").cast("string")))
    return labelled.groupBy("segment", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


# --- quality ---------------------------------------------------------------------------------------------------


_COMPLETE = """SELECT round(avg(completeness_pct / 100), 4) AS average, round(sum(completeness_pct / 100 * w) / sum(w), 4) AS weighted, round(min(completeness_pct / 100), 4) AS minimum
FROM (SELECT *, CASE WHEN "column" IN ('email', 'balance') THEN 2e0 ELSE 1e0 END AS w FROM miss)"""


@query("completeness_scores", sql("SELECT * FROM complete", complete=_COMPLETE, miss=_MISSING, up=_UP))
def completeness_scores(spark, d):
    return profile.completeness(profile_missing(spark, d), ["email", "balance"])


_SURE = """SELECT (count(*) FILTER (regexp_matches(trim(email), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$')) / count(email)::DOUBLE
  + count(*) FILTER (regexp_matches(trim(phone_number), '^[\\+]?[(]?[0-9]{1,4}[)]?[-\\s\\.]?[(]?[0-9]{1,4}[)]?[-\\s\\.]?[0-9]{1,9}$')) / count(phone_number)::DOUBLE) / 2 AS pii FROM up"""


@query("quality_report", sql("""SELECT CAST(4 AS BIGINT) AS parts, round((0.9e0 * 0.2e0 + weighted * 0.5e0 + pii * 0.2e0 + 1e0 * 0.1e0) / (0.2e0 + 0.5e0 + 0.2e0 + 0.1e0), 4) AS quality_score
  FROM complete, sure""", sure=_SURE, complete=_COMPLETE, miss=_MISSING, up=_UP))
def quality_report(spark, d):
    """Four measured parts of an uploaded file: confidence of its schema, completeness, how surely its personal columns are some, whether its text can be decoded."""
    df, path = upload(spark, d), scratch.folder(spark, "quality")
    df.select(*_COLUMNS).write.csv(path, header=True)
    schema = detect.schema(spark, path, "part-*").agg(F.min("confidence").alias("schema"))
    readable = detect.layouts(files.list_files(spark, path, "part-*")).agg(F.bool_and(F.col("encoding") != "binary").cast("int").alias("readable"))

    def share(column, shape):
        return F.count_if(F.trim(column).rlike(profile.TEXT_PATTERNS[shape])) / F.count(column)

    personal = df.agg(((share("email", "EMAIL") + share("phone_number", "PHONE")) / 2).alias("pii"))
    one = completeness_scores(spark, d).crossJoin(F.broadcast(schema)).crossJoin(F.broadcast(readable)).crossJoin(F.broadcast(personal))  # one row each
    return profile.quality_score(one.select(F.inline(profile.quality_parts(F.col("schema"), F.col("weighted"), F.col("pii"), F.col("readable")))))


@query("pipeline_summary", sql("""SELECT CAST(count(*) AS BIGINT) AS columns, count(*) FILTER (null_count > 0) AS columns_with_nulls, CAST(3 AS BIGINT) AS numeric_columns,
  CAST(1 AS BIGINT) AS names, CAST(1 AS BIGINT) AS emails, CAST(1 AS BIGINT) AS phones, CAST(1 AS BIGINT) AS ids FROM miss""", miss=_MISSING, up=_UP))
def pipeline_summary(spark, d):
    """Column counts of the hand-off summary from the profile tables."""
    gaps = profile_missing(spark, d)
    kinds = profile_types(spark, d)
    category = privacy.column_category(F.col("column"))
    return gaps.join(kinds, "column").withColumn("category", category).agg(
        F.count(F.lit(1)).alias("columns"), F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
        F.count_if(F.col("type").isin("integer", "float")).alias("numeric_columns"),
        *[F.count_if(F.col("category") == c).alias(c) for c in ("names", "emails", "phones", "ids")])


# --- personal data -----------------------------------------------------------------------------------------------


@query("pii_columns", sql("""SELECT "column", category, CASE category WHEN 'names' THEN 'tokenize' WHEN 'addresses' THEN 'generalize' WHEN NULL THEN NULL ELSE CASE WHEN category IS NOT NULL THEN 'hash' END END AS method FROM (
  SELECT "column", CASE "column" WHEN 'full_name' THEN 'names' WHEN 'email' THEN 'emails' WHEN 'phone_number' THEN 'phones' WHEN 'customer_id' THEN 'ids' END AS category FROM miss)""", miss=_MISSING, up=_UP))
def pii_columns(spark, d):
    category = privacy.column_category(F.col("column"))
    return profile_missing(spark, d).select("column", category.alias("category"), privacy.masking_method(category).alias("method"))


@query("pii_hash", sql("""SELECT customer_id, substr(sha256('pepper' || email), 1, 16) AS email, substr(sha256('pepper' || phone_number), 1, 16) AS phone_number FROM up""", up=_UP))
def pii_hash(spark, d):
    return privacy.mask(upload(spark, d), {"email": "hash", "phone_number": "hash"}, salt="pepper").select("customer_id", "email", "phone_number")


@query("pii_generalize", sql("""SELECT customer_id, CASE WHEN full_name IS NOT NULL THEN '[REDACTED]' END AS full_name, '[PII]' AS segment FROM up""", up=_UP))
def pii_generalize(spark, d):
    return privacy.mask(upload(spark, d), {"full_name": "generalize", "segment": "generalize"}).select("customer_id", "full_name", "segment")


@query("pii_tokenize", sql("""SELECT customer_id, 'PII_full_name_' || rk AS full_name FROM up LEFT JOIN (
  SELECT full_name, row_number() OVER (ORDER BY sha256(full_name)) AS rk FROM (SELECT DISTINCT full_name FROM up WHERE full_name IS NOT NULL)) USING (full_name)""", up=_UP))
def pii_tokenize(spark, d):
    return privacy.mask(upload(spark, d), {"full_name": "tokenize"}).select("customer_id", "full_name")


def _redact_sql(text):
    for n, p in privacy.TEXT_PII.items():
        text = f"regexp_replace({text}, '{p}', '[{n.upper()}]', 'g')"
    return text


@query("pii_text_scan", "SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS {n}" for n, p in privacy.TEXT_KINDS.items()) + f", md5({_redact_sql('text')}) AS redacted_md5 FROM documents")
def pii_text_scan(spark, d):
    """Nine kinds of values in whole document texts: counts per kind, and a digest of the text without those that identify someone."""
    text = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", *[privacy.count_in_text(text, n).alias(n) for n in privacy.TEXT_KINDS], F.md5(privacy.redact_text(text)).alias("redacted_md5"))


# --- scalar parsing ------------------------------------------------------------------------------------------------


@query("safe_numeric", sql("SELECT customer_id, coalesce(TRY_CAST(replace(amount_text, ',', '') AS DOUBLE), 0e0) AS amount, coalesce(TRY_CAST(segment AS DOUBLE), 0e0) AS rubbish FROM up", up=_UP))
def safe_numeric(spark, d):
    return upload(spark, d).select("customer_id", parse.safe_number(F.col("amount_text")).alias("amount"), parse.safe_number(F.col("segment")).alias("rubbish"))


@query("parse_dates", sql("SELECT account_id, strftime(opened, '%Y-%m-%d') AS opened FROM report_account"))
def parse_dates(spark, d):
    return views.accounts(spark, d).select("account_id", F.date_format(parse.parse_date(F.col("date_opened")), "yyyy-MM-dd").alias("opened"))


@query("age_years", sql("SELECT request_id, CAST(coalesce(date_sub('year', birth_day, DATE '2012-06-30'), 0) AS INTEGER) AS age_years FROM applicant WHERE birth_day IS NULL OR birth_day <= DATE '2012-06-30'"))
def age_years(spark, d):
    birth = parse.day_first_date(F.col("birth_date"))
    return views.applicants(spark, d).filter(birth.isNull() | (birth <= F.lit(AsOf().birth))).select(
        "request_id", parse.age_in_years(birth, AsOf().birth).alias("age_years"))


@query("date_to_iso", sql("""SELECT customer_id, CASE WHEN contains(signup_date, '-') THEN signup_date ELSE strftime(coalesce(try_strptime(signup_date, '%m/%d/%Y'), try_strptime(signup_date, '%d/%m/%Y')), '%Y-%m-%d') END AS iso,
  CASE WHEN contains(signup_date, '-') THEN 'ISO' WHEN try_strptime(signup_date, '%m/%d/%Y') IS NOT NULL THEN 'US_SLASH' ELSE 'EU_SLASH' END AS layout FROM up""", up=_UP))
def date_to_iso(spark, d):
    """Ambiguous day/month texts read month first, as the order of layouts says."""
    return upload(spark, d).select("customer_id", parse.date_to_iso(F.col("signup_date")).alias("iso"), parse.date_layout(F.col("signup_date")).alias("layout"))


# --- internal schema ------------------------------------------------------------------------------------------------

# Field -> (lowest, highest) allowed value; the first seven are mandatory.
INTERNAL_RANGES = {
    "approved": (0, 1), "age": (18, 80), "monthly_income": (0, 100000), "loan_amount_requested": (0, 500000),
    "loan_tenure_months": (1, 360), "existing_loans_balance": (0, 500000), "monthly_loan_repayment": (0, 100000),
    "employment_years": (0, 50), "account_balance": (0, 1000000), "savings_balance": (0, 1000000),
    "average_monthly_balance": (0, 1000000), "account_age_months": (0, 600), "monthly_transactions_count": (0, 500),
    "num_existing_loans": (0, 20), "credit_history_months": (0, 360), "num_credit_inquiries": (0, 20), "num_late_payments": (0, 50),
}
MANDATORY = list(INTERNAL_RANGES)[:7]
# Employment types.
EMPLOYMENT = ["Salaried", "Self-Employed", "Government"]


def internal_rows(spark, d):
    key = F.col("c_custkey")
    fields = []
    for i, (name, (low, high)) in enumerate(INTERNAL_RANGES.items()):
        span = int((high - low) * 1.02) + 1
        value = F.lit(low) + key * (i * 2 + 7) % span
        absent = key % (i + 11) == 3 if name in MANDATORY else key % (i + 2) == 1
        fields.append(F.when(~absent, value).alias(name))
    kinds = F.array(*[F.lit(e) for e in [*EMPLOYMENT, "Other"]])
    return table(spark, d, "customer").select(key.alias("key"), *fields, F.get(kinds, (key % 5).cast("int")).alias("employment_type"))


def _internal_sql():
    cols = []
    for i, (name, (low, high)) in enumerate(INTERNAL_RANGES.items()):
        span = int((high - low) * 1.02) + 1
        absent = f"c_custkey % {i + 11} = 3" if name in MANDATORY else f"c_custkey % {i + 2} = 1"
        cols.append(f"CASE WHEN NOT ({absent}) THEN {low} + c_custkey * {i * 2 + 7} % {span} END AS {name}")
    return "SELECT c_custkey AS key, " + ", ".join(cols) + ", (['Salaried','Self-Employed','Government','Other'])[c_custkey % 5 + 1] AS employment_type FROM customer"


_PRESENT = " + ".join(f"CAST({n} IS NOT NULL AS INTEGER)" for n in [*INTERNAL_RANGES, "employment_type"])


def internal_errors(minimum=12):
    """Problems of one internal record, in field order."""
    names = [*INTERNAL_RANGES, "employment_type"]
    filled = sum((F.col(n).isNotNull().cast("int") for n in names[1:]), F.col(names[0]).isNotNull().cast("int"))
    checks = [F.when(F.col(n).isNull(), F.lit(f"missing {n}")) for n in MANDATORY]
    checks += [F.when(~F.col(n).between(low, high), F.lit(f"range {n}")) for n, (low, high) in INTERNAL_RANGES.items()]
    checks += [F.when(~F.col("employment_type").isin(EMPLOYMENT), F.lit("enum employment_type")),
               F.when(filled < minimum, F.lit("too few fields"))]
    return F.array_compact(F.array(*checks)), filled


@query("internal_schema_check", sql(f"SELECT key, CAST({_PRESENT} AS INTEGER) AS field_count, concat_ws(',', "
                                    + ", ".join([f"CASE WHEN {n} IS NULL THEN 'missing {n}' END" for n in MANDATORY]
                                                + [f"CASE WHEN {n} NOT BETWEEN {lo} AND {hi} THEN 'range {n}' END" for n, (lo, hi) in INTERNAL_RANGES.items()])
                                    + f", CASE WHEN employment_type = 'Other' THEN 'enum employment_type' END, CASE WHEN {_PRESENT} < 12 THEN 'too few fields' END) AS errors FROM internal", internal=_internal_sql()))
def internal_schema_check(spark, d):
    errors, filled = internal_errors()
    return internal_rows(spark, d).select("key", filled.alias("field_count"), F.array_join(errors, ",").alias("errors"))


@query("ml_features_18", sql("""SELECT key, CAST(coalesce(approved, 0) AS INTEGER) AS approved, CAST(coalesce(age, 0) AS DOUBLE) AS age, CAST(coalesce(monthly_income, 0) AS DOUBLE) AS monthly_income,
  CAST(coalesce(monthly_loan_repayment, 0) AS DOUBLE) AS monthly_loan_repayment, employment_type, CAST(num_late_payments AS INTEGER) AS num_late_payments,
  CASE WHEN monthly_income > 0 THEN round(coalesce(monthly_loan_repayment, 0) / monthly_income::DOUBLE, 6) END AS debt_to_income_ratio FROM internal""", internal=_internal_sql()))
def ml_features_18(spark, d):
    """Internal record to model features; mandatory gaps count as 0, the ratio needs an income."""
    c = F.col
    income, repay = F.coalesce(c("monthly_income"), F.lit(0)).cast("double"), F.coalesce(c("monthly_loan_repayment"), F.lit(0)).cast("double")
    return internal_rows(spark, d).select(
        "key", F.coalesce(c("approved"), F.lit(0)).cast("int").alias("approved"), F.coalesce(c("age"), F.lit(0)).cast("double").alias("age"),
        income.alias("monthly_income"), repay.alias("monthly_loan_repayment"), "employment_type",
        c("num_late_payments").cast("int").alias("num_late_payments"),
        F.round(repay / F.when(income > 0, income), 6).alias("debt_to_income_ratio"))
