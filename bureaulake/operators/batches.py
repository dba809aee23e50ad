"""Batch input checks, routing, envelopes and job bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import parse
from bureaulake.functions.bins import case


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no`` (1-based per file, blank lines skipped) to ``value, file, block``.

    ``block`` is the start offset of the file split.  Splits are counted first and get cumulative offsets, so
    no single task ever orders a whole file.
    """
    kept = lines.filter(F.trim("value") != "").withColumn("row_id", F.monotonically_increasing_id())
    blocks = kept.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_id"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    starts = blocks.select("file", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return kept.join(starts, ["file", "block"]).select(
        "file", (F.col("start") + F.col("row_id") - F.col("first_id") + 1).alias("line_no"),
        F.trim("value").alias("line"))


def key_difference(features: Column) -> tuple[Column, Column]:
    """(missing, extra) keys of a feature map against the thirty names, both sorted."""
    names = F.array(*[F.lit(n) for n in catalog.FEATURES])
    keys = F.map_keys(features)
    return F.array_sort(F.array_except(names, keys)), F.array_sort(F.array_except(keys, names))


def applicant_errors(request_id: Column, copies: Column, features: Column, metadata: Column) -> Column:
    """First reason a batch applicant is refused, or null."""
    missing, extra = key_difference(features)
    empty = F.filter(F.map_keys(features), lambda k: features[k].isNull())
    return case([
        (~parse.filled(request_id), F.lit("request_id is required")),
        (copies > 1, F.concat(F.lit("duplicate request_id "), request_id)),
        (features.isNull(), F.lit("features must be an object")),
        ((F.size(missing) > 0) | (F.size(extra) > 0), F.concat(
            F.lit("keys mismatch; missing: "), F.array_join(missing, ","), F.lit("; extra: "), F.array_join(extra, ","))),
        (F.size(empty) > 0, F.concat(F.lit("null features: "), F.array_join(F.array_sort(empty), ","))),
        (metadata.isNull(), F.lit("metadata must be an object")),
        (~parse.filled(metadata["data_source_id"]), F.lit("metadata.data_source_id is required")),
        (~parse.filled(metadata["source_system"]), F.lit("metadata.source_system is required")),
    ])


def with_copies(df: DataFrame, key: str = "request_id") -> DataFrame:
    """Adds ``copies`` and ``is_first``: how often the key occurs and whether this line comes first.

    Counts are aggregated map-side and joined back, so a key with very many lines is no problem for one task
    (AQE splits the join side when it is skewed). Lines without a key have neither and stay out of the join.
    """
    known = df.filter(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), F.min("line_no").alias("first_line"))
    joined = known.join(counts, key).withColumn("is_first", F.col("line_no") == F.col("first_line")).drop("first_line")
    return joined.unionByName(df.filter(F.col(key).isNull()), allowMissingColumns=True)


def id_style(ids: DataFrame) -> DataFrame:
    """One row: whether all lines or no lines carry a request id."""
    explicit = parse.filled(F.col("request_id"))
    return ids.agg(F.count(F.lit(1)).alias("lines"), F.count_if(explicit).alias("with_id")).select(
        "lines", "with_id", ((F.col("lines") < 2) | (F.col("with_id") == 0) | (F.col("with_id") == F.col("lines"))).alias("uniform"))


def model_subset(raw: Column) -> Column:
    """Requested models from ``all``, a comma list or a JSON list; blank means all, unknown names are dropped.

    An empty result means that nothing valid was asked for, which callers report as an error.
    """
    everything = F.array(*[F.lit(m) for m in catalog.MODELS])
    text = F.trim(F.coalesce(raw, F.lit("")))
    listed = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.split(text, ","))
    names = F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda m: F.trim(m))
    chosen = F.array_intersect(names, everything)
    return F.when(F.array_contains(names, "all") | (text == ""), everything).otherwise(chosen)


def error_code(error_type: Column, message: Column, system: Column) -> Column:
    kind, text, name = F.lower(error_type), F.lower(message), F.lower(system)

    def says(col, *words):
        out = F.lit(False)
        for w in words:
            out = out | col.contains(w)
        return out

    intro, private = says(name, "introspection", "system 0"), says(name, "anonymiz", "pii", "system 4")
    return case([
        (intro & says(text, "format"), "SCHEMA_DETECTION_FAILED"),
        (intro, "INTROSPECTION_FAILED"),
        (says(name, "schema detection", "system 1"), "SCHEMA_DETECTION_FAILED"),
        (says(name, "sampling", "system 2"), "DATA_SAMPLING_FAILED"),
        (says(name, "analysis", "system 3"), "DATA_ANALYSIS_FAILED"),
        (private & says(text, "detection"), "PII_DETECTION_FAILED"),
        (private, "ANONYMIZATION_FAILED"),
        (says(name, "mapping", "system 5"), "SCHEMA_MAPPING_FAILED"),
        (says(kind, "connection") | says(text, "connection"), "CONNECTION_ERROR"),
        (says(kind, "storage") | says(text, "blob", "adls"), "STORAGE_ERROR"),
        (says(kind, "validation", "keyerror") | says(text, "missing"), "VALIDATION_ERROR"),
    ], "UNKNOWN_ERROR")


# What the uploader is told per error code.
ERROR_TEXT = {
    "INTROSPECTION_FAILED": "The file could not be opened. Check it and send it again.",
    "SCHEMA_DETECTION_FAILED": "The kind of file is unknown. Send CSV, TSV, JSON lines, Parquet or text.",
    "DATA_SAMPLING_FAILED": "No rows could be read from the file.",
    "DATA_ANALYSIS_FAILED": "The rows could not be profiled. Check the values of each column.",
    "PII_DETECTION_FAILED": "Personal data could not be found safely, so the file was not used.",
    "ANONYMIZATION_FAILED": "Personal data could not be masked, so the file was not used.",
    "SCHEMA_MAPPING_FAILED": "The columns do not match the required ones.",
    "STORAGE_ERROR": "The stored file is out of reach. Try again.",
    "CONNECTION_ERROR": "A service did not answer. Try again later.",
    "VALIDATION_ERROR": "Required fields are missing.",
    "UNKNOWN_ERROR": "Something went wrong. Ask for help and name the upload id.",
}


def error_text(code: Column) -> Column:
    return case([(code == c, text) for c, text in ERROR_TEXT.items()], ERROR_TEXT["UNKNOWN_ERROR"])


def route(df_cols=F.col) -> Column:
    c = df_cols
    run, upload = c("run_id").isNotNull(), c("training_upload_id").isNotNull()
    sub = c("subscription")
    return case([
        (c("processing_system") == "ADF", "adf-trigger-subscription"),
        (run & (sub == "quality_report"), "quality_report"),
        ((sub == "start-transformation") & run & upload & c("bank_id").isNotNull() & c("bronze_blob_path").isNotNull()
         & (c("status").isNull() | (c("status") != "ERROR")), "start-transformation"),
        ((sub == "transformed") & (c("status") == "TRANSFORMED") & run & c("transformed_file_path").isNotNull(), "transformed"),
        (run & (sub == "failed"), "failed"),
        ((c("status") == "MAPPING_COMPLETE") & (sub == "mapping-complete"), "mapping-complete"),
        (run & upload & sub.isin("analysis-complete", "anonymization-complete", "introspection-complete",
                                 "sampling-complete", "schema-detected"), sub),
    ])


def is_mapping_trigger(c=F.col) -> Column:
    """Only bronze hand-offs start schema mapping; results of later stages are skipped."""
    return (c("transformed_file_path").isNull() & c("quality_report").isNull() & parse.filled(c("bronze_blob_path"))
            & parse.filled(c("bank_id")) & parse.filled(c("training_upload_id")))


def clean_path(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(path), r"\\", "/"), r"^(bronze/)+", "")


def align_extension(path: Column, declared: Column) -> Column:
    """Rewrite the suffix of the file name to the declared format when they disagree."""
    suffix = F.lower(F.regexp_replace(F.trim(declared), r"^\.+", ""))
    name = F.substring_index(path, "/", -1)
    has_suffix = name.rlike(r"^.+\.[^.]+$")
    current = F.when(has_suffix, F.lower(F.substring_index(name, ".", -1)))
    stem = F.when(has_suffix, F.regexp_replace(path, r"\.[^./]+$", "")).otherwise(path)
    wanted = F.concat(stem, F.lit("."), suffix)
    return F.when(parse.filled(suffix) & (current.isNull() | (current != suffix)), wanted).otherwise(path)


PATH_SHAPE = r"training/([^/]+)/(\d{4}-\d{2}-\d{2})/([^/]+?)(?:\.([^/]+))?$"


def path_parts(path: Column) -> dict[str, Column]:
    """Bank, date, upload id and format from a bronze path."""
    matches = path.rlike(PATH_SHAPE)
    names = ["path_bank", "path_date", "path_upload", "path_format"]
    return {n: F.when(matches, F.regexp_extract(path, PATH_SHAPE, i)) for i, n in enumerate(names, start=1)}


def event_errors(c=F.col) -> Column:
    """Problems of a bronze hand-off event, empty when it can be processed."""
    upload, bank, path = c("training_upload_id"), c("bank_id"), c("bronze_blob_path")
    cleaned = clean_path(path)
    return F.array_compact(F.array(
        F.when(~parse.filled(upload), F.lit("training_upload_id")),
        F.when(~parse.filled(bank), F.lit("bank_id")),
        F.when(~parse.filled(path), F.lit("bronze_blob_path")),
        F.when(parse.filled(path) & ~cleaned.startswith("training/"), F.lit("path_prefix")),
        F.when(parse.filled(upload) & (F.length(F.trim(upload)) < 10), F.lit("upload_id_length")),
        F.when(parse.filled(path) & ~cleaned.rlike(r"(^|/)\d{4}-\d{2}-\d{2}(/|$)"), F.lit("path_date")),
    ))


def job_progress(results: DataFrame) -> DataFrame:
    """Status per job from its result and error rows; nothing is ever updated in place."""
    return results.groupBy("job_id").agg(
        F.max("total").alias("total"), F.count_if(F.col("outcome") == "ok").alias("completed"),
        F.count_if(F.col("outcome") == "error").alias("failed"),
    ).withColumn("status", F.when(F.col("completed") + F.col("failed") >= F.col("total"), F.lit("complete"))
                 .otherwise("in_progress"))


def training_run(results: DataFrame) -> DataFrame:
    """COMPLETE when every reported model succeeded, FAILED when none did, else PARTIAL."""
    ok = F.col("status") == "SUCCESS"
    return results.groupBy("training_id").agg(
        F.count(F.lit(1)).alias("models"), F.count_if(ok).alias("succeeded"),
        F.round(F.sum("duration_seconds"), 6).alias("total_duration"),
    ).withColumn("run_status", F.when(F.col("succeeded") == F.col("models"), F.lit("COMPLETE"))
                 .when(F.col("succeeded") > 0, F.lit("PARTIAL")).otherwise("FAILED"))
