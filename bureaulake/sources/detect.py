"""Folders of mixed uploads: what each file is, and one read per layout.

Every file is looked at once, in a task: compression, encoding, format scores, delimiter, header, column names. Files of one layout
(all of that equal) are read together, so the plan grows with the number of layouts and not of uploads; the driver holds one path
per file, as Spark's own file index does. Spark's readers take what they can split or decompress themselves. Other files (UTF-16,
compression that the name doesn't tell, xz, zstd) are decoded by tasks, line by line.

A file whose name and content disagree is read as its content says. If that gives no row, it is read as its name says.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureaulake.functions.bins import case
from bureaulake.operators import profile
from bureaulake.shipping import ship
from bureaulake.sources import decode, files

#: Share of cells of the first line that are no numbers from which it is a header.
HEADER_SHARE = 0.7
#: Lines or characters a task hands on at once.
LINES, CHARACTERS = 10_000, 4 << 20
DEFAULT_SEPARATOR = {"csv": ",", "tsv": "\t"}
READABLE = ["csv", "tsv", "txt", "json", "jsonl", "parquet"]
#: Names that the readers add; a column of an upload with such a name gets a number. Where a row comes from, until then.
RESERVED, SOURCE = ["_file", "_format", "_bad"], "__source_file"
KEY = ["format", "separator", "header", "names", "encoding", "array", "native"]


def cells(line: Column, separator: Column) -> Column:
    """The fields of one line; quotes around a field and doubled quotes in it go."""
    quoted = F.concat(F.lit("\\Q"), separator, F.lit("\\E"))
    pattern = F.concat(F.lit('("(?:[^"]|"")*"|[^'), F.when(separator == "\t", F.lit("\\t")).otherwise(F.concat(F.lit("\\"), separator)), F.lit(']*)'), quoted)
    raw = F.regexp_extract_all(F.concat(line, separator), pattern, F.lit(1))
    return F.transform(raw, lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"([\s\S]*)"$', "$1"), F.lit('""'), F.lit('"')))


def is_number(cell: Column) -> Column:
    """Digits, points and signs only."""
    return F.regexp_replace(cell, r"[.+-]", "").rlike(r"^\s*\d+$")


def unique_names(found: Column) -> Column:
    """Names of a header line: trimmed; an empty one says where it stands, a repeated one (in any case) how often it stood before."""
    filled = F.transform(found, lambda c, i: F.when(F.trim(c) == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(F.trim(c)))

    def before(names, i):
        return F.concat(F.array(*[F.lit(r) for r in RESERVED]), F.transform(F.slice(names, F.lit(1), i), lambda c: F.lower(c)))

    def counted(c, i):
        n = F.size(F.filter(before(filled, i), lambda x: x == F.lower(c)))
        return F.when(n > 0, F.concat(c, F.lit("."), n.cast("string"))).otherwise(c)

    once = F.transform(filled, counted)
    return F.transform(once, lambda c, i: F.when(F.array_contains(before(once, i), F.lower(c)), F.concat(c, F.lit("."), i.cast("string"))).otherwise(c))


def _as_format(found: DataFrame, fmt: Column) -> DataFrame:
    """Adds how a file is read as the given format."""
    text = F.coalesce("text", F.lit(""))
    first_line = F.get(F.split(text, "\r\n|\n|\r", 2), F.lit(0))
    separator = case([(fmt.isin("csv", "tsv"), F.coalesce(F.get("delimiters", F.lit(0)), F.when(fmt == "tsv", F.lit("\t")).otherwise(","))),
                      (fmt == "txt", F.get("delimiters", F.lit(0)))])
    table = fmt.isin("csv", "tsv", "txt") & F.col("separator").isNotNull()
    words = F.size(F.filter("_cells", lambda c: (c != "") & ~is_number(c)))
    by_spark = F.col("encoding").isin("utf-8", "iso-8859-1") & (
        F.col("compression").isNull() & ~F.lower("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
        | (F.col("compression") == "gzip") & F.lower("path").endswith(".gz") | (F.col("compression") == "bzip2") & F.lower("path").endswith(".bz2"))
    rows = found.withColumns({"format": fmt, "separator": separator})
    rows = rows.withColumn("_cells", F.when(table, cells(first_line, F.col("separator"))))
    rows = rows.withColumn("header", F.when(table, F.coalesce(words / F.size("_cells") > HEADER_SHARE, F.lit(True))))
    names = F.when(F.col("header"), unique_names(F.col("_cells"))).otherwise(F.transform("_cells", lambda c, i: F.concat(F.lit("col_"), i.cast("string"))))
    lines_of_json = F.trim(text).startswith("{") & F.substring(text, 1, 1000).contains("\n")
    return rows.withColumns({
        "names": F.when(table, names), "array": F.when(fmt.isin("json", "jsonl"), ~lines_of_json),
        "encoding": F.coalesce("encoding", F.lit("binary")), "native": F.coalesce(by_spark, F.lit(False)) | (fmt == "parquet")}).drop("_cells")


def layouts(listed: DataFrame) -> DataFrame:
    """One row per listed file: format, separator, header, names, encoding, array, whether Spark's reader takes it, conflict and fallback."""
    scored = files.score_formats(files.introspect(files.probe(listed)))
    return _as_format(scored, F.col("format"))


@dataclass
class Group:
    """Files of one layout."""

    format: str
    separator: str | None
    header: bool | None
    names: tuple[str, ...] | None
    encoding: str
    array: bool | None
    native: bool
    paths: list[str]


def groups(found: DataFrame) -> list[Group]:
    """The files by layout; one path per file comes to the driver."""
    by: dict[tuple, Group] = {}
    for row in found.select(*KEY, "path").toLocalIterator():
        key = tuple(tuple(v) if isinstance(v, list) else v for v in (row[c] for c in KEY))
        by.setdefault(key, Group(*key, [])).paths.append(row["path"])
    for group in by.values():
        group.paths.sort()
    return [by[k] for k in sorted(by, key=repr)]


# --- one read per layout ------------------------------------------------------------------------------------------


def plain_path(path: Column) -> Column:
    """A path as the listing spells it, from the escaped one that a reader gives."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^(\w+):/+", "$1:/")


def read_from() -> Column:
    return plain_path(F.col("_metadata.file_path")).alias(SOURCE)


def _escaped(paths: list[str]) -> list[str]:
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def decoded_lines(spark: SparkSession, paths: list[str], encoding: str, skip_first: bool, whole: bool) -> DataFrame:
    """``value`` and source of the files that tasks decompress and decode: line by line, or with ``whole`` one row per file."""
    ship(spark)

    def short(path: str) -> str:
        return re.sub(r"^(\w+):/+", r"\1:/", path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                with decode.opened(path) as handle:
                    kind = decode.compression_of(handle.read(16))
                    handle.seek(0)
                    found = decode.lines(decode.content(handle, kind), encoding)
                    if whole:
                        yield pd.DataFrame({"value": [" ".join(found)], SOURCE: [short(path)]})
                        continue
                    if skip_first:
                        next(found, None)
                    held, size = [], 0
                    for line in found:
                        held.append(line)
                        size += len(line)
                        if len(held) >= LINES or size >= CHARACTERS:
                            yield pd.DataFrame({"value": held, SOURCE: short(path)})
                            held, size = [], 0
                    if held:
                        yield pd.DataFrame({"value": held, SOURCE: short(path)})

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 10_000), F.col("path"))
    return listed.mapInPandas(run, f"value string, {SOURCE} string")


def _delimited(spark: SparkSession, group: Group) -> DataFrame:
    names = [*group.names, "_bad"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"sep": group.separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    if group.native:
        rows = spark.read.csv(_escaped(group.paths), schema=schema, header=group.header, encoding=group.encoding, enforceSchema=True, **options)
        rows = rows.select("*", read_from())
    else:
        lines = decoded_lines(spark, group.paths, group.encoding, group.header, False).filter("value <> ''")
        rows = lines.select(F.from_csv("value", ", ".join(f"`{n.replace('`', '``')}` string" for n in names), options).alias("r"), SOURCE).select("r.*", SOURCE)
    return rows.filter(files.fits(list(group.names), group.separator)).drop("_bad")


def _json(spark: SparkSession, group: Group) -> DataFrame:
    """JSON objects as rows with dotted columns; what is no JSON is skipped."""
    if group.native:
        lines = spark.read.text(_escaped(group.paths), wholetext=bool(group.array)).select("value", read_from())
        if group.encoding != "utf-8":
            lines = decoded_lines(spark, group.paths, group.encoding, False, bool(group.array))
    else:
        lines = decoded_lines(spark, group.paths, group.encoding, False, bool(group.array))
    parsed = lines.select(F.try_parse_json("value").alias("v"), "value", SOURCE).filter("v is not null")
    shape = parsed.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    listed = shape.startswith("ARRAY<")
    inner = shape[6:-1] if listed else shape
    if not inner.startswith("OBJECT<"):
        raise ValueError(f"no JSON objects but {shape[:80]}")
    kind = re.sub(r"\bOBJECT<", "STRUCT<", inner).replace("VARIANT", "STRING").replace("VOID", "STRING")
    records = F.from_json("value", f"ARRAY<{kind}>")  # an object alone counts as a list of one
    return files.flatten_structs(parsed.select(F.explode(records).alias("r"), SOURCE).select("r.*", SOURCE))


def read_group(spark: SparkSession, group: Group) -> DataFrame:
    """All rows of the files of one layout, with their file in the column SOURCE."""
    if group.format == "parquet":
        rows = spark.read.option("mergeSchema", "true").parquet(*_escaped(group.paths)).select("*", read_from())
        return files.flatten_structs(rows)
    if group.format in ("json", "jsonl"):
        return _json(spark, group)
    if group.names:
        return _delimited(spark, group)
    if group.native and group.encoding == "utf-8":
        lines = spark.read.text(_escaped(group.paths)).select("value", read_from())
    else:
        lines = decoded_lines(spark, group.paths, group.encoding, False, False)
    return lines.filter(F.trim("value") != "").withColumnRenamed("value", "text")


def as_text(df: DataFrame) -> DataFrame:
    """All columns as strings, lists as JSON."""
    def shown(f):
        value = F.col(f"`{f.name}`")
        return (F.to_json(value) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else value.cast("string")).alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _finished(rows: DataFrame, group: Group) -> DataFrame:
    """All values as text, columns of reserved names renamed, the file in ``_file`` and the format in ``_format``."""
    own = [f"{c}.1" if c.lower() in RESERVED else c for c in rows.columns if c != SOURCE]
    text = as_text(rows)
    return text.select(*[F.col(f"`{c}`") for c in rows.columns if c != SOURCE], SOURCE).toDF(*own, "_file").withColumn("_format", F.lit(group.format))


def _attempt(spark: SparkSession, group: Group) -> tuple[DataFrame | None, str | None]:
    """The group's rows, or why they can't be read this way."""
    if group.format not in READABLE:
        return None, f"no reader for {group.format}"
    try:
        return _finished(read_group(spark, group), group), None
    except (PySparkException, ValueError) as error:
        return None, str(error).splitlines()[0][:300]


def _filled(loaded: DataFrame | None) -> set[str]:
    """The files that have a row; one name per file comes to the driver."""
    if loaded is None:
        return set()
    try:
        return {r["_file"] for r in loaded.select("_file").distinct().toLocalIterator()}
    except PySparkException:
        return set()


def read_report(spark: SparkSession, path: str, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """Rows of all files below a folder by what each file is, and the files that could not be read (path, format, problem).

    All values are text, columns are united by name, ``_file`` and ``_format`` say where a row comes from. Spreadsheets and Avro
    files are reported, not read. An empty folder gives two empty tables.
    """
    found = layouts(files.list_files(spark, path, pattern)).cache()
    parts, problems = [], []

    def keep(group: Group, loaded: DataFrame | None, problem: str | None) -> None:
        if loaded is None:
            problems.extend((p, group.format, problem) for p in group.paths)
        else:
            parts.append(loaded)

    for group in groups(found.filter("fallback IS NULL")):
        keep(group, *_attempt(spark, group))
    doubtful = found.filter("fallback IS NOT NULL")
    empty: list[str] = []
    for group in groups(doubtful):  # read as the content says, if that gives rows
        loaded, _ = _attempt(spark, group)
        filled = _filled(loaded)
        spelled = {re.sub(r"^(\w+):/+", r"\1:/", p): p for p in group.paths}
        empty += [p for key, p in spelled.items() if key not in filled]
        if filled:
            parts.append(loaded)
    if empty:  # and else as the name says
        again = doubtful.join(spark.createDataFrame([(p,) for p in empty], "path string"), "path")
        for group in groups(_as_format(again, F.col("fallback"))):
            keep(group, *_attempt(spark, group))
    found.unpersist()
    rows = None
    for part in parts:
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    rows = spark.createDataFrame([], "_file string, _format string") if rows is None else rows
    return rows, spark.createDataFrame(problems, "path string, format string, problem string")


def read_all(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The rows of :func:`read_report`."""
    return read_report(spark, path, pattern)[0]


# --- schema ---------------------------------------------------------------------------------------------------------


def schema(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """column, type, n, votes, has_header and confidence of the table in a folder of files of one layout.

    Types are the majority over all values. The confidence weighs how sure the format is (0.3), that there are columns (0.4), the
    share of columns with a type (0.2) and that there are rows (0.1).
    """
    found = layouts(files.list_files(spark, path, pattern))
    (group,) = groups(found)
    rows = read_group(spark, group).drop(SOURCE)
    kinds = profile.majority_types(as_text(rows))
    names = spark.createDataFrame([(i, n) for i, n in enumerate(rows.columns)], "position int, column string")
    typed = names.join(kinds, "column", "left").withColumns({"type": F.coalesce("type", F.lit("unknown")), "n": F.coalesce("n", F.lit(0)), "votes": F.coalesce("votes", F.lit(0))})
    total, commas = F.size("delimiters") > 0, F.size("delimiters") == 1
    sure = found.agg(F.min(F.least(F.lit(0.9), F.when(total, 0.4).otherwise(0.0) + F.when(commas, 0.3).otherwise(0.0) + F.when(~F.col("conflict"), 0.2).otherwise(0.0)
                                   + F.when(F.col("magic").isNotNull(), 0.9).otherwise(0.0))).alias("format"), F.first("header").alias("has_header"))
    overall = typed.agg(F.count(F.lit(1)).alias("columns"), F.count_if(F.col("type") != "unknown").alias("known"), F.max("n").alias("rows")).crossJoin(F.broadcast(sure))  # one row
    shares = overall.select("has_header", F.round(
        0.3 * F.col("format") + 0.4 * F.when(F.col("columns") > 0, 0.9).otherwise(0.5)
        + 0.2 * F.when(F.col("known") > 0, F.least(F.lit(0.9), 0.5 + 0.4 * F.col("known") / F.col("columns"))).otherwise(0.3)
        + 0.1 * F.when(F.col("rows") > 0, 0.9).when(F.col("columns") > 0, 0.7).otherwise(0.3), 4).alias("confidence"))
    return typed.crossJoin(F.broadcast(shares)).select("column", "type", "n", "votes", "has_header", "confidence")  # one row
