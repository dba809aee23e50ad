"""Uploaded files: listing, byte probes, introspection, format scores and readers.

Spark lists the files and spreads them over tasks.  A task opens each of its files for a few byte ranges or,
when a checksum is wanted, streams it in chunks, so file size is no limit and nothing is read whole into memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureaulake.functions.bins import case
from bureaulake.shipping import ship
from bureaulake.sources import decode

HEAD_BYTES = 8192
SAMPLE_BYTES = 65536
CHUNK_BYTES = 8 << 20
#: Files whose samples a task holds at once.
PROBED_AT_ONCE = 64


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length`` of all files below a folder; the content column is pruned, so no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            .load(path).select("path", "length"))


def _probe(frames: Iterator[pd.DataFrame], checksum: bool) -> Iterator[pd.DataFrame]:
    import hashlib

    for frame in frames:
        rows = []
        for path, length in zip(frame["path"], frame["length"]):
            with decode.opened(path) as handle:
                def part(offset, size):
                    handle.seek(max(0, offset))
                    return handle.read(size)

                head = part(0, SAMPLE_BYTES)
                compression = decode.compression_of(head)
                handle.seek(0)
                inner = decode.head_of(handle, compression, SAMPLE_BYTES) if compression else head
                encoding, bom = decode.encoding_of(inner, len(inner) < SAMPLE_BYTES)
                middle = part(length // 2, SAMPLE_BYTES) if length > 3 * SAMPLE_BYTES else b""
                tail = part(length - SAMPLE_BYTES, SAMPLE_BYTES) if length > 3 * SAMPLE_BYTES else b""
                digest = None
                if checksum:
                    sha = hashlib.sha256()
                    handle.seek(0)
                    while chunk := handle.read(CHUNK_BYTES):
                        sha.update(chunk)
                    digest = sha.hexdigest()
            rows.append((path, length, head, middle, tail, digest, compression, decode.container_of(head), encoding, bom,
                         inner[:16].hex().upper(), decode.text_of(inner, encoding)))
            if len(rows) == PROBED_AT_ONCE:
                yield pd.DataFrame(rows, columns=PROBED)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=PROBED)


PROBED = ["path", "length", "head", "middle", "tail", "sha256", "compression", "container", "encoding", "bom", "start", "text"]


def probe(files: DataFrame, checksum: bool = False) -> DataFrame:
    """Adds three byte samples, what the head is (compression, container, encoding, its text) and, on request, the SHA-256 of the whole file."""
    ship(files.sparkSession)
    spread = files.repartition(F.col("path"))  # one file may be far larger than another; spread them evenly
    schema = ("path string, length long, head binary, middle binary, tail binary, sha256 string, compression string, container string, encoding string, bom string, "
              "start string, text string")
    return spread.mapInPandas(lambda frames: _probe(frames, checksum), schema)


def _starts(hexed: Column, *prefixes: str) -> Column:
    found = hexed.startswith(prefixes[0])
    for p in prefixes[1:]:
        found = found | hexed.startswith(p)
    return found


def count_of(text: Column, token: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))) / len(token)).cast("int")


DELIMITERS = [",", "\t", "|", ";"]


QUOTED = r'"(?:[^"]|"")*"'


def introspect(probed: DataFrame) -> DataFrame:
    """Newline, binary flag, delimiters, boundary, reader hints and format hints from the decoded head; compression and encoding stay."""
    text, hexed = F.coalesce(F.substring("text", 1, HEAD_BYTES), F.lit("")), F.col("start")
    newline = case([(text.contains("\r\n"), "CRLF"), (text.contains("\n"), "LF"), (text.contains("\r"), "CR")])
    base = probed.withColumns({
        "is_binary": F.col("encoding").isNull(),
        "newline": newline, "_lines": F.filter(F.slice(F.split(text, "\r\n|\n|\r"), 1, 10), lambda s: F.trim(s) != ""),
        "magic": case([(_starts(hexed, "50415231"), "parquet"), (_starts(hexed, "504B0304", "504B0506", "504B0708", "D0CF11E0"), "excel"), (_starts(hexed, "4F626A01"), "avro"),
                       (text.rlike(r"^[\{\[]"), "json")]),
    })
    rows = F.col("_lines")

    def consistent(token):
        bare = F.transform(F.slice(rows, 1, 5), lambda s: F.regexp_replace(s, QUOTED, ""))  # delimiters inside quotes don't count
        total = F.aggregate(bare, F.lit(0), lambda a, s: a + count_of(s, token))
        return F.when((F.size(rows) >= 2) & (total > 0) & (total >= F.least(F.size(rows), F.lit(5)) * 0.8), F.struct((-total).alias("n"), F.lit(token).alias("d")))

    lengths = F.transform(rows, lambda s: F.length(s))
    mean = F.aggregate(lengths, F.lit(0.0), lambda a, n: a + n) / F.greatest(F.size(lengths), F.lit(1))
    even = (F.size(rows) >= 3) & F.forall(F.slice(lengths, 1, 5), lambda n: F.abs(n - mean) < 0.05 * mean)
    ranked = F.transform(F.array_sort(F.array_compact(F.array(*[consistent(t) for t in DELIMITERS]))), lambda s: s["d"])
    base = base.withColumns({
        "delimiters": F.when(F.col("newline").isNotNull() & ~F.col("is_binary"), ranked).otherwise(F.array().cast("array<string>")),
        "record_length": F.when(F.col("newline").isNotNull() & even & ~F.col("is_binary"), mean.cast("int")),
    })
    stream = F.col("container").isNull() & (F.col("compression").isNotNull() | (F.col("length") > 10 * 1024 * 1024))
    name = F.regexp_replace(F.lower("path"), r"\.(gz|gzip|bz2|xz|zst)$", "")
    beginning = F.substring(text, 1, 100)
    return base.withColumns({
        "boundary": case([(F.size("delimiters") > 0, "delimited"), (F.col("record_length").isNotNull(), "fixed-width"),
                          (F.col("newline").isNotNull() & ~F.col("is_binary"), "newline-delimited")], "unknown"),
        "reader": F.when(stream, F.lit("streaming")).otherwise("random_access"),
        "possible_json": text.rlike(r"^[\{\[]"), "possible_csv": beginning.contains(","), "possible_tsv": beginning.contains("\t"),
        "possible_parquet": F.col("magic").eqNullSafe(F.lit("parquet")), "possible_excel": F.col("magic").eqNullSafe(F.lit("excel")),
        "extension": F.regexp_extract(name, r"\.([^./]+)$", 1),
    }).drop("head", "middle", "tail", "start", "_lines")


# Extension -> format, and whether the format is binary.
EXTENSIONS = {"csv": "csv", "tsv": "tsv", "json": "json", "jsonl": "jsonl", "parquet": "parquet", "xlsx": "excel",
              "xls": "excel", "txt": "txt", "avro": "avro"}
BINARY_FORMATS = ["parquet", "excel", "avro"]
TEXT_FORMATS = ["csv", "tsv", "json", "jsonl", "txt"]


def score_formats(inventory: DataFrame) -> DataFrame:
    """Weighted evidence per format: magic 15, extension 5, content hint 3, zip 2, delimiter 2; the best wins."""
    named = case([(F.col("extension") == e, f) for e, f in EXTENSIONS.items()])
    binary, c = F.col("is_binary"), F.col

    def points(fmt):
        right = binary if fmt in BINARY_FORMATS else ~binary
        score = F.when(c("magic") == fmt, 15).otherwise(0) + F.when(c("by_name") == fmt, 5).otherwise(0)
        if fmt == "csv":
            score = score + F.when(c("possible_csv"), 3).otherwise(0) + F.when(F.array_contains("delimiters", ","), 2).otherwise(0)
        if fmt == "tsv":
            score = score + F.when(c("possible_tsv"), 3).otherwise(0) + F.when(F.array_contains("delimiters", "\t"), 2).otherwise(0)
        if fmt == "json":
            score = score + F.when(c("possible_json"), 3).otherwise(0)
        if fmt == "parquet":
            score = score + F.when(c("possible_parquet"), 3).otherwise(0)
        if fmt == "excel":
            score = score + F.when(c("possible_excel"), 3).otherwise(0) + F.when(c("container") == "zip", 2).otherwise(0)
        return F.struct(F.when(right, score).otherwise(0).alias("score"), F.lit(fmt).alias("format"))

    order = BINARY_FORMATS + TEXT_FORMATS
    best = F.array_max(F.array(*[F.struct(points(f)["score"].alias("s"), F.lit(-i).alias("p"), F.lit(f).alias("f")) for i, f in enumerate(order)]))
    scored = inventory.withColumn("by_name", named).withColumn("best", best)
    found = F.when(c("best.s") > 0, c("best.f")).otherwise(F.when(binary, F.lit("parquet")).otherwise("txt"))
    return scored.withColumns({
        "format": found, "score": c("best.s"),
        "conflict": (c("best.s") <= 0) | F.coalesce(c("by_name") != found, F.lit(False)),
        "fallback": F.when(F.coalesce(c("by_name") != found, F.lit(False)), c("by_name")),
    }).drop("best")


def estimate_rows(probed: DataFrame) -> DataFrame:
    """Newlines in the byte samples scaled to the file size."""
    parts = [F.coalesce(F.col(p), F.lit(b"")) for p in ("head", "middle", "tail")]
    seen = sum((F.length(p) for p in parts[1:]), F.length(parts[0]))
    breaks = sum((count_of(F.decode(p, "ISO-8859-1"), "\n") for p in parts[1:]), count_of(F.decode(parts[0], "ISO-8859-1"), "\n"))
    return probed.select("path", "length", F.floor(breaks * F.col("length") / F.greatest(seen, F.lit(1))).alias("estimated_rows"))


# --- readers -----------------------------------------------------------------------------------------------


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited text; lines with too many fields are skipped, missing trailing fields become null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_bad"]])
    rows = spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE",
                          columnNameOfCorruptRecord="_bad", enforceSchema=True)
    return rows.filter(fits(columns, sep)).drop("_bad")


def fits(columns: list[str], sep: str) -> Column:
    """Whether a line, kept in ``_bad`` if it is corrupt, has no more fields than there are columns."""
    unquoted = F.regexp_replace("_bad", r'"(?:\\.|""|[^"\\])*"', "")  # separators inside quotes don't count
    too_many = F.col("_bad").isNotNull() & (count_of(unquoted, sep) >= len(columns))
    return ~too_many | (F.length(F.col(f"`{columns[0]}`")) < 0)  # never true: a reader must be asked for a real column as well


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool = False) -> DataFrame:
    """JSON lines, or one JSON document per file with ``array``; what is no JSON is skipped, a field of another type is null."""
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.json(path, schema=wide, multiLine=array, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    return rows.filter(F.col("_bad").isNull() | F.try_parse_json("_bad").isNotNull()).drop("_bad")


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct fields as dotted columns; arrays stay as they are."""
    def leaves(name, kind, value):
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in leaves(f"{name}.{f.name}", f.dataType, value[f.name])]
        return [value.alias(name)]

    return df.select(*[x for f in df.schema.fields for x in leaves(f.name, f.dataType, F.col(f"`{f.name}`"))])


def probe_delimiter(lines: DataFrame) -> str | None:
    """Delimiter that occurs in at least 80 % of the lines with the highest count; one small row comes back."""
    stats = lines.filter(F.trim("value") != "").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col("value").contains(t)).alias(f"has{i}") for i, t in enumerate(DELIMITERS)], *[
        F.sum(count_of(F.col("value"), t)).alias(f"sum{i}") for i, t in enumerate(DELIMITERS)]).first()
    usable = [(stats[f"sum{i}"], t) for i, t in enumerate(DELIMITERS) if stats["n"] and stats[f"has{i}"] >= 0.8 * stats["n"]]
    return max(usable)[1] if usable else None


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text split on the probed delimiter into ``col_0..``; one ``text`` column when there is none."""
    lines = spark.read.text(path)
    token = probe_delimiter(lines)
    if token is None:
        return lines.filter(F.trim("value") != "").withColumnRenamed("value", "text")
    width = lines.agg(F.max(count_of(F.col("value"), token)).alias("w")).first()["w"] + 1
    parts = F.split("value", "\\" + token if token in "|" else token)
    return lines.filter(F.trim("value") != "").select(*[F.get(parts, F.lit(i)).alias(f"col_{i}") for i in range(width)])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, block`` for :func:`bureaulake.operators.batches.number_lines`."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def nesting(schema: T.StructType) -> list[tuple[str, int, bool]]:
    """(path, depth, is_array) of every field of a schema."""
    rows = []

    def walk(prefix, kind, depth):
        if isinstance(kind, T.ArrayType):
            return walk(prefix, kind.elementType, depth)
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                path = f"{prefix}.{f.name}" if prefix else f.name
                rows.append((path, depth, isinstance(f.dataType, T.ArrayType)))
                walk(path, f.dataType, depth + 1)
        return None

    walk("", schema, 1)
    return rows
