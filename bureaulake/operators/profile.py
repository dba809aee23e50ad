"""Profiles of uploaded tables: one pass per table, one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureaulake.functions import parse
from bureaulake.functions.bins import case
from bureaulake.operators.ranking import quantiles_of_counts, value_counts
from bureaulake.sources import scratch

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
Z_LIMIT = 1.96


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def per_column(df: DataFrame, columns: list[str], metrics, keys: list[str] = ()) -> DataFrame:
    """``metrics(column) -> {name: aggregate}`` for all columns in one aggregation, then one row per column (and ``keys``)."""
    aggregated = df.groupBy(*keys).agg(*[
        F.struct(F.lit(c).alias("column"), *[m.alias(n) for n, m in metrics(c).items()]).alias(f"_{i}")
        for i, c in enumerate(columns)])
    return aggregated.select(*keys, F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def missing_metrics(c: str) -> dict[str, Column]:
    return {"null_count": F.count_if(F.col(c).isNull()), "total_rows": F.count(F.lit(1))}


def completeness_pct() -> Column:
    share = (F.col("total_rows") - F.col("null_count")) / F.when(F.col("total_rows") > 0, F.col("total_rows")) * 100
    return F.round(F.coalesce(share, F.lit(0.0)), 2)


def missing(df: DataFrame) -> DataFrame:
    pattern = case([(F.col("null_count") == 0, "complete"), (F.col("null_count") < F.col("total_rows"), "random")], "all_null")
    return per_column(df, df.columns, missing_metrics).select("column", "null_count", completeness_pct().alias("completeness_pct"), "total_rows", pattern.alias("pattern"))


def distribution(df: DataFrame, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """min, max, mean, median, sample standard deviation and distinct count of the numeric columns.

    Exact medians and distinct counts come from one stored count per (column, value): the table is read twice altogether.
    ``exact=False`` takes everything from one pass with sketches of fixed size.
    """
    columns = numeric_columns(df)

    def metrics(c):
        v = F.col(c).cast("double")
        out = {"n": F.count(c), "min": F.min(v), "max": F.max(v), "mean": F.avg(v), "std": F.coalesce(F.stddev_samp(v), F.lit(0.0))}
        if not exact:
            out |= {"median": F.percentile_approx(v, 0.5, accuracy), "unique_count": F.approx_count_distinct(c)}
        return out

    stats = per_column(df, columns, metrics).filter("n > 0")
    if exact:
        counts = value_counts(as_double_rows(df, columns), ["column"])
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
        medians = quantiles_of_counts(counts, ["column"], [0.5]).select("column", F.col("quantile").alias("median"))
        stats = stats.join(distinct, "column").join(medians, "column")
    return stats


def as_double_rows(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Long form ``column, value`` of numeric columns."""
    cast = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(keep), columns, "column", "value")


def outliers(df: DataFrame, key: str, exact_stats: DataFrame | None = None) -> DataFrame:
    """All values more than 1.96 standard deviations from the mean of their column."""
    columns = [c for c in numeric_columns(df) if c != key]

    def metrics(c):
        v = F.col(c).cast("double")
        return {"mean": F.avg(v), "std": F.stddev_samp(v)}

    stats = per_column(df, columns, metrics) if exact_stats is None else exact_stats
    rows = as_double_rows(df, columns, [key]).join(F.broadcast(stats.filter("std > 0")), "column")  # one row per column
    return rows.filter(F.abs((F.col("value") - F.col("mean")) / F.col("std")) > Z_LIMIT).select("column", key, "value")


def smallest_per_group(df: DataFrame, keys: list[str], order: str, values: list[str], limit: int, salt: int = 256) -> DataFrame:
    """``limit`` rows with the smallest ``order`` per group, for reports of the top rows; ranked in salted sub-groups first."""
    from pyspark.sql import Window

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salt)))
    part = Window.partitionBy(*keys, "_salt").orderBy(order, *values)
    whole = Window.partitionBy(*keys).orderBy(order, *values)
    first = salted.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= limit)
    return first.withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= limit).drop("_r", "_salt")


def logical_type(field: T.StructField) -> Column:
    """Aggregate: integer, float, boolean, datetime, string_numeric or string; all rows are tested, not a sample."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        looks = F.bool_and(F.when(F.col(field.name).isNotNull(), F.trim(F.col(field.name)).rlike(parse.NUMBER)))
        return F.when(F.coalesce(looks, F.lit(True)), F.lit("string_numeric")).otherwise("string")
    typed = {(T.FloatType, T.DoubleType, T.DecimalType): "float", NUMERIC: "integer", (T.BooleanType,): "boolean",
             (T.DateType, T.TimestampType, T.TimestampNTZType): "datetime"}
    return F.max(F.lit(next((name for kinds, name in typed.items() if isinstance(kind, kinds)), "string")))


def logical_types(df: DataFrame) -> DataFrame:
    fields = {f.name: f for f in df.schema.fields}
    return per_column(df, df.columns, lambda c: {"type": logical_type(fields[c])})


def schema_hash(types: DataFrame) -> DataFrame:
    """SHA-256 over the sorted ``column:type`` list; the input has one row per column."""
    pairs = F.array_sort(F.collect_list(F.struct("column", "type")))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(p["column"], F.lit(":"), p["type"])), "|")
    return types.agg(F.sha2(text, 256).alias("schema_hash"))


# Named text shapes.
TEXT_PATTERNS = {
    "EMAIL": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "PHONE": r"^[\+]?[(]?[0-9]{1,4}[)]?[-\s\.]?[(]?[0-9]{1,4}[)]?[-\s\.]?[0-9]{1,9}$",
    "UUID": r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "GUID": r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "NATIONAL_ID": r"^[A-Z0-9]{6,20}$",
    "CREDIT_CARD": r"^[0-9]{13,19}$",
    "ALPHANUMERIC": r"(?i)^[A-Z0-9]+$",
    "NUMERIC": r"^[0-9]+$",
    "DATE_STRING": r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}",
}
SEPARATED = r"(?i)^[A-Z0-9_-]+$"


def shape_metrics(c: str, text: bool = True) -> dict[str, Column]:
    """How many values have each of the named shapes; nulls for columns that aren't text."""
    value = F.trim(F.col(c).cast("string"))
    return {n: F.count_if(value.rlike(p)) if text else F.max(F.lit(None).cast("long")) for n, p in {**TEXT_PATTERNS, "SEPARATED": SEPARATED}.items()}


def shapes(df: DataFrame, stats: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Adds ``patterns`` and ``n_distinct`` to ``column, n`` and the counts of :func:`shape_metrics`.

    Patterns that more than half of the values match; else separators, else UNIQUE_TEXT or TEXT. Only columns that no pattern
    decides need a distinct count, which is taken over hashes of 128 bits.
    """
    named = F.array_compact(F.array(*[F.when(F.col(p) > F.col("n") * 0.5, F.lit(p)) for p in TEXT_PATTERNS]))
    stats = stats.filter("n > 0").withColumn("_named", F.when(F.size(named) > 0, named).when(F.col("SEPARATED") >= F.col("n") * 0.5, F.array(F.lit("ALPHANUMERIC_WITH_SEPARATORS"))))
    texts = [c for c in text_columns(df) if c not in keys]
    open_ = F.broadcast(stats.filter("_named is null").select(*keys, "column"))  # a row per column and key
    long = df.unpivot(list(keys), texts, "column", "value").filter("value is not null").join(open_, [*keys, "column"], "left_semi")
    distinct = long.select(*keys, "column", F.xxhash64("value").alias("a"), F.xxhash64("value", F.lit(1)).alias("b")).distinct().groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("n_distinct"))
    rest = F.array(F.when(F.col("n_distinct") / F.col("n") > 0.9, F.lit("UNIQUE_TEXT")).otherwise("TEXT"))
    return stats.join(distinct, [*keys, "column"], "left").withColumn("patterns", F.coalesce("_named", rest)).drop("_named")


def text_patterns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text patterns per column; all rows count."""
    columns = text_columns(df) if columns is None else columns
    stats = scratch.written(per_column(df, columns, lambda c: {"n": F.count(c), **shape_metrics(c)}), "shapes")  # a row per column, read twice
    return shapes(df.select(*columns), stats).select("column", "n", "patterns")


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Profile of every column within each group of ``keys``: gaps, type, min, max, mean and text patterns.

    All measures come from one aggregation; a second pass counts distinct values where no pattern decides.
    """
    fields = {f.name: f for f in df.schema.fields if f.name not in keys}

    def metrics(c):
        number = F.col(c).cast("double") if isinstance(fields[c].dataType, NUMERIC) else F.lit(None).cast("double")
        text = isinstance(fields[c].dataType, T.StringType)
        return {**missing_metrics(c), "n": F.count(c), "type": logical_type(fields[c]), "min": F.min(number), "max": F.max(number), "mean": F.avg(number),
                "is_text": F.max(F.lit(text)), **shape_metrics(c, text)}

    stats = scratch.written(per_column(df, list(fields), metrics, keys).withColumn("completeness_pct", completeness_pct()), "profiles")  # a row per column and group
    found = shapes(df, stats.filter("is_text"), keys).select(*keys, "column", "patterns")
    return stats.join(found, [*keys, "column"], "left").select(*keys, "column", "type", "n", "completeness_pct", "min", "max", "mean", "patterns")


def date_formats(df: DataFrame, columns: list[str], minimum: int = 5) -> DataFrame:
    """Share of each date layout per text column with at least ``minimum`` filled values."""
    long = df.unpivot([], columns, "column", "value").filter(
        parse.filled(F.col("value")) & (F.lower(F.trim("value")) != "nan"))
    counted = long.groupBy("column", parse.date_layout(F.col("value")).alias("layout")).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("column").agg(F.sum("n").alias("total")).filter(F.col("total") >= minimum)
    return counted.filter("layout is not null").join(totals, "column").select(
        "column", "layout", "n", F.round(F.col("n") / F.col("total"), 4).alias("confidence"))


CURRENCY = r"(\$|€|£|GHS|₵)"


def value_formats(df: DataFrame) -> DataFrame:
    """Format per column: datetime, number, date or text, with separators and currency seen."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def metrics(c):
        kind, value = kinds[c], F.trim(F.col(c).cast("string"))
        if isinstance(kind, T.StringType):
            is_date, is_number = parse.date_layout(value).isNotNull(), parse.number_or_null(value).isNotNull()
        else:
            timed = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
            is_date, is_number = F.lit(timed), F.lit(isinstance(kind, NUMERIC))
        as_text = F.lit(isinstance(kind, T.StringType))
        return {
            "typed": F.max(F.lit("datetime" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
                                 else "number" if isinstance(kind, NUMERIC) else "text")),
            "n": F.count(c), "dates": F.count_if(is_date & F.col(c).isNotNull()), "numbers": F.count_if(is_number & F.col(c).isNotNull()),
            "thousands": F.coalesce(F.bool_or(as_text & value.contains(",")), F.lit(False)),
            "decimals": F.coalesce(F.bool_or(as_text & value.contains(".")), F.lit(False)),
            "currency": F.coalesce(F.bool_or(as_text & value.rlike(CURRENCY)), F.lit(False)),
        }

    kind = case([(F.col("typed") != "text", F.col("typed")), (F.col("dates") > F.col("n") / 2, F.lit("date")),
                 (F.col("numbers") == F.col("n"), F.lit("number"))], F.lit("text"))
    shown = kind == "number"
    return per_column(df, df.columns, metrics).filter("n > 0").select(
        "column", kind.alias("format_type"), (shown & F.col("thousands")).alias("thousands"),
        (shown & F.col("decimals")).alias("decimals"), (shown & F.col("currency")).alias("currency"))


def majority_types(df: DataFrame) -> DataFrame:
    """Most frequent logical type of the values of text columns, the alphabetically first on ties."""
    value = F.trim("value")
    kind = case([
        (value == "", "empty"), (value.rlike(r"^[+-]?\d+$"), "integer"), (value.rlike(parse.NUMBER), "float"),
        (F.lower(value).isin("true", "false"), "boolean"), (parse.date_layout(value).isNotNull(), "date")], "string")
    long = df.unpivot([], df.columns, "column", "value").filter("value is not null")
    counts = long.groupBy("column", kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("type", F.struct((-F.col("n")).alias("n"), "type")).alias("type"), F.sum("n").alias("n"), F.max("n").alias("votes"))


def column_sets(presence: DataFrame) -> DataFrame:
    """One row: how many columns any sample has and how many all have, from ``sample_id, column`` of columns with values."""
    samples = presence.agg(F.count_distinct("sample_id").alias("samples"))
    each = presence.groupBy("column").agg(F.count_distinct("sample_id").alias("n")).crossJoin(F.broadcast(samples))  # one row
    return each.agg(F.count(F.lit(1)).alias("all_columns"), F.count_if(F.col("n") == F.col("samples")).alias("common_columns"))


def examples(df: DataFrame, columns: list[str], size: int = 3, width: int = 50) -> DataFrame:
    """Up to ``size`` different values of each column, those with the smallest hashes, as text cut to ``width`` characters.

    The size belongs to the report. The smallest hash of each first byte is known after one partial aggregation; the ``size``-th of
    these can only be too large as a limit, so a second pass needs to look at the few values up to it.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value").filter("value is not null")
    long = long.withColumn("d", F.md5(F.col("value").cast("binary")))
    firsts = long.groupBy("column", F.substring("d", 1, 2).alias("part")).agg(F.min("d").alias("d"))
    limits = firsts.groupBy("column").agg(F.get(F.array_sort(F.collect_list("d")), F.lit(size - 1)).alias("limit"))  # at most 256 a column
    near = long.join(F.broadcast(limits), "column").filter(F.col("limit").isNull() | (F.col("d") <= F.col("limit")))  # a row per column
    kept = smallest_per_group(near.select("column", "d", "value").distinct(), ["column"], "d", ["value"], size)
    listed = kept.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("d", F.substring("value", 1, width).alias("value")))).alias("top"))
    return listed.select("column", F.transform("top", lambda t: t["value"]).alias("examples"))


def merged(profiles: DataFrame) -> DataFrame:
    """Profiles of several samples to one: numbers averaged, the most frequent type, patterns united."""
    votes = profiles.groupBy("column", "type").agg(
        F.count(F.lit(1)).alias("votes"), F.sum("completeness_pct").alias("c"), F.count("mean").alias("numbers"), F.sum("mean").alias("mean"), F.sum("min").alias("min"),
        F.sum("max").alias("max"), F.flatten(F.collect_set("patterns")).alias("patterns"))
    whole = votes.groupBy("column").agg(
        F.min_by("type", F.struct((-F.col("votes")).alias("v"), "type")).alias("type"), F.sum("votes").alias("samples"), F.sum("numbers").alias("numbers"),
        *[F.sum(c).alias(c) for c in ("c", "mean", "min", "max")], F.array_sort(F.array_distinct(F.flatten(F.collect_list("patterns")))).alias("patterns"))
    numbers = F.when(F.col("numbers") > 0, F.col("numbers"))
    return whole.select("column", "type", (F.col("c") / F.col("samples")).alias("completeness_pct"), *[(F.col(c) / numbers).alias(c) for c in ("mean", "min", "max")],
                        "samples", "patterns")


def across(profiles: DataFrame) -> DataFrame:
    """What samples say about each column: in how many it has values, the union of its types, and average, least and most values."""
    return profiles.groupBy("column").agg(
        F.count_if(F.col("n") > 0).alias("samples"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"),
        F.avg("n").alias("avg_filled"), F.min("n").alias("min_filled"), F.max("n").alias("max_filled"))


def completeness(missing_rows: DataFrame, critical: list[str], weight: float = 2.0) -> DataFrame:
    """Average, weighted and minimum completeness of a table in [0, 1]."""
    w = F.when(F.col("column").isin(critical), F.lit(weight)).otherwise(1.0)
    share = F.col("completeness_pct") / 100
    return missing_rows.agg(
        F.round(F.avg(share), 4).alias("average"), F.round(F.sum(share * w) / F.sum(w), 4).alias("weighted"),
        F.round(F.min(share), 4).alias("minimum"))


def quality_score(parts: DataFrame) -> DataFrame:
    """Weighted mean of the parts that have a score; expects ``part, score, weight``."""
    used = F.col("score") > 0
    return parts.agg(F.count_if(used).alias("parts"), F.round(
        F.sum(F.when(used, F.col("score") * F.col("weight"))) / F.sum(F.when(used, F.col("weight"))), 4).alias("quality_score"))


def quality_parts(schema: Column, completeness_: Column, pii: Column, readable: Column) -> Column:
    # Share of each part in the quality score.
    weights = {"schema": 0.2, "completeness": 0.5, "pii": 0.2, "readable": 0.1}
    values = {"schema": schema, "completeness": completeness_, "pii": pii, "readable": readable}
    return F.array(*[F.struct(F.lit(n).alias("part"), values[n].cast("double").alias("score"), F.lit(w).alias("weight"))
                     for n, w in weights.items()])
