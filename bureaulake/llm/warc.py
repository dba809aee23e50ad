"""Web pages as WARC archives with revisit records, read back into one capture index in global order.

Archives are text files of whole records, each ended by CR LF CR LF as the format asks, with as many records as bound their size.
A payload of at least LEAST bytes that several pages have is stored once, with the largest page_id; the other records are
revisits with the same digest and refer to it. Reading parses every archive and recomputes the digests of stored payloads.

The index merge is external: each archive gives a run of captures sorted by URL key and time; runs are dealt out by ranges of
both, and each range merges its pieces of all runs with a loser tree. So a URL with very many captures is spread over ranges,
and positions run through all ranges.

Null pages have an empty payload. Null URLs have the empty key. Rows with a null page_id are stored as responses and don't stand
for others; rows that share the largest page_id of their payload are all responses. Payloads may hold any characters.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bureaulake.llm.common import partitions, prepare, runs
from bureaulake.sources import scratch

#: Bytes from which equal payloads are stored once.
LEAST = 1000
RECORDS_PER_FILE = 1000
END = "\r\n\r\n"
#: The table has no times: page n counts as captured n seconds after the first, within these bounds.
FIRST_CAPTURE, LAST_SECOND = datetime(2024, 1, 1, tzinfo=UTC), 200_000_000_000
NO_ID = (1 << 128) - 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "url_key string, time long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"
COLUMNS = [part.strip().split(" ")[0] for part in ENTRY.split(",")]
ARROW = pa.schema([("url_key", pa.string()), ("time", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])


# ---- records


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=NO_ID if page_id is None else page_id & ((1 << 64) - 1))}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    return None if number == NO_ID else number - (1 << 64) if number >= 1 << 63 else number


def url_key(url: str | None) -> str:
    """Host labels from the top down, then path and query."""
    if url is None:
        return ""
    scheme, found, rest = url.partition("://")
    if not found:
        return url
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = rest[:at].partition(":")[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + rest[at:]


def record(page_id: int | None, url: str | None, payload: str, refers_to: int | None) -> str:
    raw = payload.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}{END}"
    time = FIRST_CAPTURE + timedelta(seconds=min(max(page_id or 0, 0), LAST_SECOND))
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {time.isoformat().replace('+00:00', 'Z')}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(raw).digest()).decode()}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    block = http if refers_to is not None else http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block.encode())}"]) + END + block


#: Printable characters but blank and percent, which would not come back as they were.
SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        yield head, archive[end + 4 : end + 4 + size]
        at = end + 4 + size
        if archive[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record not ended at {at}")
        at += 4


def entry(head: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, page = head["WARC-Type"], page_of(head["WARC-Record-ID"])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    intact = kind == "revisit" or (hashlib.sha1(payload).hexdigest() == digest and len(payload) == size)
    time = int((datetime.fromisoformat(head["WARC-Date"]) - FIRST_CAPTURE).total_seconds())
    url = head.get("WARC-Target-URI")
    return (url_key(None if url is None else unquote(url)), time, page, size, digest, kind, page_of(head["WARC-Refers-To"]) if kind == "revisit" else None, intact)


# ---- archives


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([record(*r) for r in rows], pa.string())], names=["record"])


def write(pages: DataFrame, path: str) -> None:
    """A record per row of (page_id, url, html), in gzip files below ``path``."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= LEAST, F.sha2(F.col("payload").cast("binary"), 256)))
    stands = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("stands"), F.count("*").alias("n")).where("n > 1 and stands is not null")
    joined = rows.join(stands.drop("n"), "same", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") < F.col("stands"), F.col("stands")).alias("refers_to"))
    joined.mapInArrow(_record_batches, "record string").write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _order(row: tuple) -> tuple:
    """By URL key and time; null ids first among equals."""
    return row[0], row[1], -(1 << 63) - 1 if row[2] is None else row[2], row[4], row[5]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each archive, its sorted run."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            found = sorted((entry(*r) for r in records(gzip.decompress(content))), key=_order)
            if found:
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), ARROW.types, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), pa.array(range(len(found)), pa.int64()), *columns], names=["run", "place", *COLUMNS])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives: run, place in the run, and the columns of an entry."""
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_read, f"run string, place long, {ENTRY}")


# ---- index


def merge(pieces: list[list], key: Callable) -> Iterator:
    """Items of sorted lists in order, by a loser tree: each inner node keeps the list that lost there."""
    k = len(pieces)
    if k == 0:
        return
    at = [0] * k
    heads = [(0, key(p[0]), i) if p else (1, None, i) for i, p in enumerate(pieces)]  # used-up lists lose against all
    less = lambda a, b: heads[a][:1] < heads[b][:1] or (heads[a][0] == heads[b][0] == 0 and heads[a][1:] < heads[b][1:])
    tree = [-1] * k

    def settle(i: int) -> int | None:
        """Plays list i up from its leaf; the winner, or None if it waits at an inner node."""
        node = (i + k) // 2
        while node:
            if tree[node] < 0:
                tree[node] = i
                return None
            if less(tree[node], i):
                tree[node], i = i, tree[node]
            node //= 2
        return i

    winner = 0
    for i in range(k):
        found = settle(i)
        winner = i if k == 1 else winner if found is None else found
    while heads[winner][0] == 0:
        yield pieces[winner][at[winner]]
        at[winner] += 1
        rest = at[winner] < len(pieces[winner])
        heads[winner] = (0, key(pieces[winner][at[winner]]), winner) if rest else (1, None, winner)
        i, node = winner, (winner + k) // 2
        while node:
            if less(tree[node], i):
                tree[node], i = i, tree[node]
            node //= 2
        winner = i


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, pieces = TaskContext.get().partitionId(), []
    for _, rows in runs(batches, ["run"], COLUMNS):  # sorted by run and place: the pieces in their runs' order
        pieces.append(list(zip(*(rows[c] for c in COLUMNS), strict=True)))
    out, place = [], 0
    for row in merge(pieces, _order):
        out.append((part, place, *row))
        place += 1
        if len(out) == 10_000:
            yield _merged(out)
            out = []
    if out:
        yield _merged(out)


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), *ARROW.types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["part", "place", *COLUMNS])


def merged_index(captures: DataFrame) -> DataFrame:
    """The captures with ``position`` in the order of URL key, time and page_id, from 0."""
    spark = captures.sparkSession
    dealt = captures.repartitionByRange(partitions(spark), "url_key", "time", "page_id").sortWithinPartitions("run", "place")
    ordered = dealt.mapInArrow(_merge_ranges, f"part int, place long, {ENTRY}")
    path = scratch.folder(spark, "index")
    ordered.write.parquet(path)
    ordered = spark.read.schema(ordered.schema).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ordered.join(offsets, "part").withColumn("position", F.col("before") + F.col("place")).select(*COLUMNS, "position")


def archive(pages: DataFrame) -> DataFrame:
    """Writes all pages below the shared folder and returns the merged index of what is read back."""
    spark = pages.sparkSession
    path = scratch.folder(spark, "warc")
    write(pages, path)
    return merged_index(read(spark, path))
