"""Queries: scans, file inventory, verified copies and sinks, on files Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureaulake.functions import parse
from bureaulake.operators import batches, privacy, profile
from bureaulake.queries.ctes import sql
from bureaulake.queries.monitoring_queries import verified
from bureaulake.queries.profile_queries import _COLUMNS, _MISSING, _UP, upload
from bureaulake.sources import detect, files, reports, scratch
from bureaulake.sources.views import table

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


_NARROW = ["customer_id", "email", "segment", "signup_date"]


def _with_bad_lines(spark, d, sep):
    """Every 50th line has too many fields."""
    rows = upload(spark, d).select(*[F.col(c).cast("string") for c in _NARROW])
    extra = F.when(F.col("customer_id").cast("long") % 50 == 7, F.concat(F.lit(sep), F.lit("x"), F.lit(sep), F.lit("y"))).otherwise("")
    return rows.withColumn("signup_date", F.concat("signup_date", extra))


def _delimited(spark, d, sep, name):
    path = scratch.folder(spark, name)
    _with_bad_lines(spark, d, sep).write.csv(path, sep=sep, header=True, quote="\u0000", emptyValue="")
    return path


_SCAN = sql("SELECT customer_id, email, segment, signup_date FROM up WHERE customer_id % 50 <> 7", up=_UP)


def _scanned(spark, path):
    """A folder read by what detection says of its files."""
    return detect.read_all(spark, path, "part-*").select(F.col("customer_id").try_cast("long").alias("customer_id"), *_NARROW[1:])


@query("scan_csv", _SCAN)
def scan_csv(spark, d):
    """Separator, header and names as detected; lines with too many fields are skipped."""
    return _scanned(spark, _delimited(spark, d, ",", "csv"))


@query("scan_tsv", _SCAN)
def scan_tsv(spark, d):
    return _scanned(spark, _delimited(spark, d, "\t", "tsv"))


def _struct(**fields):
    return T.StructType([T.StructField(n, kind) for n, kind in fields.items()])


_TEXT = T.StringType()
_NESTED = _struct(id=T.LongType(), who=_struct(name=_TEXT, contact=_struct(email=_TEXT)), tags=T.ArrayType(_TEXT))


def _nested(spark, d):
    return upload(spark, d).select(
        F.col("customer_id").alias("id"), F.struct(F.col("full_name").alias("name"), F.struct("email").alias("contact")).alias("who"),
        F.array("segment").alias("tags"))


_NESTED_SQL = sql("SELECT customer_id AS id, full_name AS who_name, email AS who_email, segment AS tag FROM up WHERE customer_id % 40 <> 3", up=_UP)


def _flat_names(df):
    flat = files.flatten_structs(df)
    return flat.select("id", F.col("`who.name`").alias("who_name"), F.col("`who.contact.email`").alias("who_email"),
                       F.get("tags", F.lit(0)).alias("tag"))


@query("scan_jsonl", _NESTED_SQL)
def scan_jsonl(spark, d):
    """JSON lines, every 40th broken."""
    path = scratch.folder(spark, "jsonl")
    text = F.to_json(F.struct("id", "who", "tags"))
    line = F.when(F.col("id") % 40 == 3, F.substring(text, 1, 12)).otherwise(text)
    _nested(spark, d).select(line.alias("value")).write.text(path)
    return _flat_names(files.read_json(spark, path, _NESTED))


@query("scan_json_array", sql("SELECT customer_id AS id, full_name AS who_name, email AS who_email, segment AS tag FROM up", up=_UP))
def scan_json_array(spark, d):
    """JSON documents that hold an array of objects each; a document is built from one bounded block of keys."""
    path = scratch.folder(spark, "json")
    documents = _nested(spark, d).groupBy(F.floor(F.col("id") / 400).alias("block")).agg(
        F.to_json(F.collect_list(F.struct("id", "who", "tags"))).alias("value"))  # at most 400 records each
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _flat_names(files.read_json(spark, path, _NESTED, array=True))


@query("scan_parquet", sql("SELECT segment, count(*) AS n, round(sum(balance), 4) AS balance FROM up WHERE nation < 10 GROUP BY 1", up=_UP))
def scan_parquet(spark, d):
    """Explicit schema, pushed filter, two columns read."""
    path = scratch.folder(spark, "parquet")
    upload(spark, d).write.parquet(path)
    rows = spark.read.schema("segment string, balance double, nation int").parquet(path)
    return rows.filter("nation < 10").groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 4).alias("balance"))


@query("scan_txt", sql("SELECT CAST(customer_id AS VARCHAR) AS col_0, segment AS col_1, signup_date AS col_2 FROM up WHERE customer_id % 30 <> 11", up=_UP))
def scan_txt(spark, d):
    """Text with a delimiter and no header; every 30th line has a field too many and is skipped."""
    path = scratch.folder(spark, "txt")
    extra = F.when(F.col("customer_id") % 30 == 11, F.lit("|x")).otherwise("")
    upload(spark, d).select(F.concat(F.concat_ws("|", F.col("customer_id").cast("string"), "segment", "signup_date"), extra).alias("value")).write.text(path)
    return detect.read_all(spark, path, "part-*").select("col_0", "col_1", "col_2")


#: What each upload folder holds: its share of the customers, and what its files are.
_UPLOADS = {
    "a": "parquet", "b": "csv", "c": "tab text named csv", "d": "csv.gz", "e": "JSON lines", "f": "plain text", "g": "JSON arrays", "h": "csv in UTF-16",
    "i": "tab text named tsv.gz", "j": "csv without header", "k": "JSON lines named csv", "l": "csv that begins like JSON", "m": "csv with quoted names, semicolons",
}


def _drop_folder(spark, d):
    """A bronze folder with one upload per sub-folder; some are not what their names say."""
    path = scratch.folder(spark, "bronze")
    df = upload(spark, d).select("customer_id", "segment", "nation").withColumn("part", (F.col("customer_id") % len(_UPLOADS)).cast("int"))

    def of(letter):
        return df.filter(F.col("part") == list(_UPLOADS).index(letter)).drop("part")

    def lines(letter, first, value, suffix):
        """One text file per task, each with its own first line."""
        rows = of(letter).select(value.alias("value"))
        table = rows.select("value").withColumnRenamed("value", first) if first else rows
        table.write.option("quote", "\u0000").csv(f"{path}/{letter}", header=bool(first), sep="\u0001", compression=suffix)

    json = F.to_json(F.struct("customer_id", "segment", "nation"))
    of("a").write.parquet(f"{path}/a")
    of("b").write.csv(f"{path}/b", header=True)
    of("c").write.csv(f"{path}/c", header=True, sep="\t")
    of("d").write.csv(f"{path}/d", header=True, compression="gzip")
    of("e").write.json(f"{path}/e")
    of("f").select("segment").write.text(f"{path}/f")
    blocks = of("g").groupBy(F.floor(F.col("customer_id") / 4000).alias("block")).agg(F.to_json(F.collect_list(F.struct("customer_id", "segment", "nation"))).alias("value"))
    blocks.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/g")  # at most 4000 customers a file
    of("h").write.csv(f"{path}/h", header=True, encoding="UTF-16LE")
    of("i").write.csv(f"{path}/i", header=True, sep="\t", compression="gzip")
    of("j").select("customer_id", "nation", (F.col("nation") + 1).alias("next")).write.csv(f"{path}/j", header=False)
    lines("k", None, json, "none")
    lines("l", "{customer_id},segment,nation", F.concat_ws(",", "customer_id", "segment", "nation"), "none")
    of("m").select("customer_id", F.col("segment").alias("market, segment"), "nation").write.csv(f"{path}/m", header=True, sep=";", quoteAll=True)
    return path


def _folder(path):
    return F.element_at(F.split(path, "/"), -2).alias("folder")


_KINDS = "(VALUES " + ", ".join([
    # folder, extension, compression, encoding, newline, delimiters, boundary, magic, format, separator, header, is read by Spark alone, fallback
    "('a', 'parquet', NULL, 'binary', NULL, '', 'unknown', 'parquet', 'parquet', NULL, NULL, true, NULL)",
    "('b', 'csv', NULL, 'utf-8', 'LF', ',', 'delimited', NULL, 'csv', ',', true, true, NULL)",
    "('c', 'csv', NULL, 'utf-8', 'LF', 'TAB', 'delimited', NULL, 'csv', 'TAB', true, true, NULL)",
    "('d', 'csv', 'gzip', 'utf-8', 'LF', ',', 'delimited', NULL, 'csv', ',', true, true, NULL)",
    "('e', 'json', NULL, 'utf-8', 'LF', ',', 'delimited', 'json', 'json', NULL, NULL, true, NULL)",
    "('f', 'txt', NULL, 'utf-8', 'LF', '', 'newline-delimited', NULL, 'txt', NULL, NULL, true, NULL)",
    "('g', 'txt', NULL, 'utf-8', 'LF', '', 'newline-delimited', 'json', 'json', NULL, NULL, true, 'txt')",
    "('h', 'csv', NULL, 'utf-16-le', 'LF', ',', 'delimited', NULL, 'csv', ',', true, false, NULL)",
    "('i', 'csv', 'gzip', 'utf-8', 'LF', 'TAB', 'delimited', NULL, 'csv', 'TAB', true, true, NULL)",
    "('j', 'csv', NULL, 'utf-8', 'LF', ',', 'delimited', NULL, 'csv', ',', false, true, NULL)",
    "('k', 'csv', NULL, 'utf-8', 'LF', ',', 'delimited', 'json', 'json', NULL, NULL, true, 'csv')",
    "('l', 'csv', NULL, 'utf-8', 'LF', ',', 'delimited', 'json', 'json', NULL, NULL, true, 'csv')",
    "('m', 'csv', NULL, 'utf-8', 'LF', ';', 'delimited', NULL, 'csv', ';', true, true, NULL)"]) + """
  ) k(folder, extension, compression, encoding, newline, delimiters, boundary, magic, format, separator, header, native, fallback)"""


def _tab(c):
    return F.when(c == "\t", F.lit("TAB")).otherwise(c)


@query("file_inventory", f"SELECT folder, extension, compression, nullif(encoding, 'binary') AS encoding, newline, encoding = 'binary' AS is_binary, delimiters, boundary, CASE WHEN compression IS NULL THEN 'random_access' ELSE 'streaming' END AS reader, magic FROM {_KINDS}")
def file_inventory(spark, d):
    """What the files of each upload are; one row per folder and kind of file."""
    probed = files.probe(files.list_files(spark, _drop_folder(spark, d), "part-*"))
    return files.introspect(probed).select(
        _folder("path"), "extension", "compression", "encoding", "newline", "is_binary",
        F.array_join(F.transform("delimiters", _tab), " ").alias("delimiters"), "boundary", "reader", "magic").distinct()


@query("file_format_scores", f"SELECT folder, extension, format, separator, header, native, fallback, fallback IS NOT NULL AS conflict FROM {_KINDS}")
def file_format_scores(spark, d):
    """Format, separator, header and fallback of each upload; one row per folder and layout."""
    found = detect.layouts(files.list_files(spark, _drop_folder(spark, d), "part-*"))
    return found.select(_folder("path"), "extension", "format", _tab(F.col("separator")).alias("separator"), "header", "native", "fallback", "conflict").distinct()


@query("row_count_estimate", sql("SELECT folder, n, true AS near FROM (SELECT chr(97 + CAST(customer_id % 13 AS INTEGER)) AS folder, count(*) AS n FROM up GROUP BY 1) WHERE folder IN ('b', 'c', 'j', 'l', 'm')", up=_UP))
def row_count_estimate(spark, d):
    """Rows of plain text uploads, and whether the estimate from byte samples is within a tenth of them."""
    path = _drop_folder(spark, d)
    probed = files.probe(files.list_files(spark, path, "part-*.csv"))
    headers = F.when(F.col("folder") == "j", 0).otherwise(F.count(F.lit(1)))  # a line per file
    guessed = files.estimate_rows(probed).withColumn("folder", _folder("path")).filter(F.col("folder").isin("b", "c", "j", "l", "m")).groupBy("folder").agg(
        (F.sum("estimated_rows") - headers).alias("guess"))
    counted = upload(spark, d).groupBy(F.char(97 + F.col("customer_id") % len(_UPLOADS)).alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    return guessed.join(counted, "folder").select("folder", "n", (F.abs(F.col("guess") - F.col("n")) <= F.col("n") / 10).alias("near"))


_DISPATCH = """SELECT chr(97 + CAST(customer_id % 13 AS INTEGER)) AS folder, count(*) AS n,
  CASE WHEN customer_id % 13 = 5 THEN NULL ELSE sum(customer_id) END::BIGINT AS ids, CASE WHEN customer_id % 13 IN (5) THEN NULL ELSE sum(customer_id * nation) END::BIGINT AS products,
  CASE WHEN customer_id % 13 = 9 THEN NULL ELSE sum(CAST('0x' || substr(md5(segment), 1, 6) AS BIGINT)) END::BIGINT AS digest FROM up GROUP BY customer_id % 13"""


@query("scan_dispatch", sql(_DISPATCH, up=_UP))
def scan_dispatch(spark, d):
    """All rows of a folder of mixed uploads, each read as what it is; rows and digests of the values per upload."""
    rows = detect.read_all(spark, _drop_folder(spark, d), "part-*")
    number = F.coalesce("customer_id", "{customer_id}", "col_0").try_cast("long")
    nation = F.coalesce("nation", "col_1").try_cast("long")
    segment = F.coalesce("segment", F.col("`market, segment`"), "text")
    digest = F.conv(F.substring(F.md5(segment.cast("binary")), 1, 6), 16, 10).cast("long")
    return rows.groupBy(_folder("_file")).agg(F.count(F.lit(1)).alias("n"), F.sum(number).alias("ids"), F.sum(number * nation).alias("products"), F.sum(digest).alias("digest"))


# The nested report restated: fields of both products, and when a field is filled.
_PERSONAL = "personalDetailsSummary personalDetailsSummary.consumerID personalDetailsSummary.birthDate personalDetailsSummary.birth_date personalDetailsSummary.dependants personalDetailsSummary.employerDetail personalDetailsSummary.employer personalDetailsSummary.nationalIDNo personalDetailsSummary.national_id"
_SHARED = f"response response.statusCode {_PERSONAL} highestDelinquencyRating highestDelinquencyRating.highestDelinquencyRating enquiryHistory enquiryHistory.subscriberEnquiryResultID enquiryHistory.dateRequested enquiryHistory.enquiryReason enquiryHistory.subscriberName creditAccountSummary"
_OWN = {
    "consumer_full_report_45": " ".join(["creditAccountSummary." + c for c in "totalOutstandingdebtGHS totalMonthlyInstalmentGHS totalActiveAccountsGHS totalNumberofAccountsGHS totalNumberofDishonouredGHS totalAccountInArrearGHS totalAmountInArrearGHS".split()]
        + ["creditAgreementSummary"] + ["creditAgreementSummary." + c for c in "accountStatusCode status_code monthsInArrears months_in_arrears openingBalanceAmt opening_balance_amt currentBalanceAmt current_balance dateAccountOpened date_opened closedDate accountType loanType".split()]
        + ["accountMonthlyPaymentHistory"] + [f"accountMonthlyPaymentHistory.m{m:02d}" for m in range(1, 25)] + ["judgementSummary", "defaults", "dudCheqEventSummary", "addressHistory", "addressHistory.address"]),
    "consumer_mobile_report_49": " ".join(["creditAccountSummary." + c for c in "highestAmountTaken totalOutstandingdebt totalMonthlyInstalment".split()]
        + ["detailedFacilityInfo"] + ["detailedFacilityInfo." + c for c in "accountStatusCode monthsInArrears openingBalanceAmt".split()]),
}
_PATHS = ", ".join(f"('{p}')" for r, own in _OWN.items() for p in [r, *(f"{r}.{f}" for f in (_SHARED + " " + own).split())])
_LISTS = "enquiryHistory creditAgreementSummary accountMonthlyPaymentHistory judgementSummary defaults dudCheqEventSummary addressHistory detailedFacilityInfo".split()


@query("schema_nesting", f"""SELECT path, len(string_split(path, '.'))::INTEGER AS depth, len(string_split(path, '.')) = 2 AND field IN ({', '.join(f"'{f}'" for f in _LISTS)}) AS is_array,
  count(*) FILTER (CASE WHEN path LIKE '%.personalDetailsSummary.birthDate' THEN NOT alias WHEN field = 'birth_date' THEN alias WHEN field = 'employerDetail' THEN NOT alias AND k % 3 <> 0
    WHEN field = 'employer' THEN alias AND k % 3 <> 0 WHEN field = 'nationalIDNo' THEN NOT alias AND k % 11 <> 0 WHEN field = 'national_id' THEN alias AND k % 11 <> 0
    WHEN path LIKE '%.highestDelinquencyRating.highestDelinquencyRating' THEN k % 9 <> 0 WHEN field = 'totalAccountInArrearGHS' THEN k % 6 <> 0
    WHEN field = 'judgementSummary' THEN k % 5 <> 0 WHEN field = 'defaults' THEN k % 31 = 2 WHEN field = 'dudCheqEventSummary' THEN k % 3 = 0 ELSE true END) AS filled
FROM (SELECT path, split_part(path, '.', -1) AS field FROM (VALUES {_PATHS}) v(path)), (SELECT c_custkey AS k, c_custkey % 4 = 1 AS alias FROM customer)
WHERE CASE WHEN path LIKE 'consumer_full%' THEN k % 10 <> 9 ELSE k % 10 < 3 OR k % 10 IN (7, 8) END GROUP BY path, field""")
def schema_nesting(spark, d):
    """Path, depth and array flag of a nested file, with the rows that fill each field."""
    path = scratch.folder(spark, "nested")
    reports.payloads(spark, d).select("payload.*").write.parquet(path)
    df = spark.read.parquet(path)
    rows = files.nesting(df.schema)
    filled = df.agg(*[F.count(F.col(p)).alias(f"f{i}") for i, (p, _, _) in enumerate(rows)])
    entries = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(depth).alias("depth"), F.lit(a).alias("is_array"), F.col(f"f{i}").alias("filled"))
                        for i, (p, depth, a) in enumerate(rows)])
    return filled.select(F.inline(entries))


@query("bronze_verify", sql("""SELECT 'upload=' || (customer_id % 4) AS upload, CASE customer_id % 4 WHEN 1 THEN 'verification_failed' WHEN 2 THEN 'copy_failed' ELSE 'success' END AS outcome
  FROM up GROUP BY customer_id % 4""", up=_UP))
def bronze_verify(spark, d):
    """Source and bronze folders compared by SHA-256 and size; one copy is missing a folder's files."""
    source, bronze = scratch.folder(spark, "source"), scratch.folder(spark, "copy")
    rows = upload(spark, d).select(F.col("customer_id").cast("string").alias("value"), (F.col("customer_id") % 4).alias("upload"))
    ordered = rows.repartition("upload").sortWithinPartitions("upload", "value")
    ordered.write.partitionBy("upload").text(source)
    changed = ordered.withColumn("value", F.when(F.col("upload") == 1, F.concat("value", F.lit("!"))).otherwise(F.col("value")))
    changed.filter("upload <> 2").write.partitionBy("upload").text(bronze)

    def inventory(path):
        probed = files.probe(files.list_files(spark, path, "part-*"), checksum=True)
        return probed.select(F.element_at(F.split("path", "/"), -2).alias("upload"), F.col("sha256").alias("checksum"), F.col("length").alias("size"))

    return verified(inventory(source), inventory(bronze), "upload")


@query("jsonl_lines", sql("SELECT row_number() OVER (PARTITION BY customer_id % 8 ORDER BY customer_id) AS line_no, customer_id FROM up WHERE customer_id % 25 <> 4", up=_UP))
def jsonl_lines(spark, d):
    """Line numbers of files, each read in many splits if it is large; blank lines do not count."""
    path = scratch.folder(spark, "lines")
    line = F.when(F.col("customer_id") % 25 == 4, F.lit("   ")).otherwise(F.to_json(F.struct("customer_id")))
    part = (F.col("customer_id") % 8).alias("part")
    upload(spark, d).select(part, "customer_id", line.alias("value")).repartition("part").sortWithinPartitions("part", "customer_id").select(
        "part", "value").write.partitionBy("part").text(path)
    numbered = batches.number_lines(files.read_lines(spark, f"{path}/part=*"))
    return numbered.select("line_no", F.get_json_object("line", "$.customer_id").cast("long").alias("customer_id"))


# --- sinks ---------------------------------------------------------------------------------------------------------


@query("sink_silver", sql("""SELECT 'bank-' || (customer_id % 3) AS bank_id, count(*) AS n, count(DISTINCT email) AS emails, count(*) FILTER (email IS NULL) AS gaps FROM up GROUP BY 1""", up=_UP))
def sink_silver(spark, d):
    """Masked whole table partitioned by bank, day and run."""
    path = scratch.folder(spark, "silver")
    masked = privacy.mask(upload(spark, d), {"full_name": "hash", "email": "hash", "phone_number": "hash"}, salt="pepper").withColumns({
        "bank_id": F.concat(F.lit("bank-"), F.col("customer_id") % 3), "ingest_date": F.lit("2024-01-31"), "run_id": F.lit("run-1")})
    masked.write.partitionBy("bank_id", "ingest_date", "run_id").parquet(path)
    return spark.read.parquet(path).groupBy("bank_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("email").alias("emails"), F.count_if(F.col("email").isNull()).alias("gaps"))


@query("sink_context", sql("""SELECT category, "column", completeness_pct, null_count, type, 'csv' AS format, 'utf-8' AS encoding, true AS has_header, 0.9e0 AS confidence,
  (SELECT count(*) FROM up) AS total_rows, CASE WHEN (SELECT count(*) FROM up) <= 10000 THEN 'full_dataset' ELSE 'reservoir' END AS strategy FROM miss JOIN (VALUES ('amount_text', NULL, 'string'), ('balance', NULL, 'float'),
  ('customer_id', 'ids', 'integer'), ('email', 'emails', 'string'), ('full_name', 'names', 'string'), ('nation', NULL, 'integer'), ('phone_number', 'phones', 'string_numeric'),
  ('segment', NULL, 'string'), ('signup_date', NULL, 'string')) v(c, category, type) ON c = "column" """, miss=_MISSING, up=_UP))
def sink_context(spark, d):
    """Side-car of an upload as one JSON record: what its files are, its schema, how it is sampled, gaps, types and masked columns."""
    source, path = scratch.folder(spark, "context-upload"), scratch.folder(spark, "context")
    df = upload(spark, d)
    df.select(*_COLUMNS).write.csv(source, header=True)
    found = detect.layouts(files.list_files(spark, source, "part-*"))
    introspection = found.agg(F.min("format").alias("format"), F.min("encoding").alias("encoding"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    schema = detect.schema(spark, source, "part-*").agg(F.bool_and("has_header").alias("has_header"), F.min("confidence").alias("confidence"))
    rows = F.count(F.lit(1))
    sampling = df.agg(rows.alias("total_rows"), F.when(rows <= SAMPLE_ROWS, F.lit("full_dataset")).otherwise("reservoir").alias("strategy"))
    profiled = profile.missing(df).join(profile.logical_types(df), "column").withColumn("category", privacy.column_category(F.col("column")))
    columns = profiled.agg(F.array_sort(F.collect_list(F.struct("column", "type", "null_count", "completeness_pct", "category"))).alias("columns"))  # a row per column

    def part(one, name):
        return F.broadcast(one.select(F.struct(*one.columns).alias(name)))

    record = columns.crossJoin(part(introspection, "introspection")).crossJoin(part(schema, "schema")).crossJoin(part(sampling, "sampling"))  # one row each
    record.write.json(path)
    back = spark.read.json(path)
    return back.select(F.inline("columns"), "introspection.format", "introspection.encoding", "schema.has_header", "schema.confidence", "sampling.total_rows", "sampling.strategy")


#: Rows up to which an upload is analysed as a whole instead of by samples.
SAMPLE_ROWS = 10_000
