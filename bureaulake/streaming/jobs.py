"""Structured Streaming jobs over request, result and event streams.

Sinks are tables in the scratch folder, never the driver.  Aggregations write changed groups per micro-batch;
:func:`newest` then gives the current value per key, so the output table is append-only and a replayed batch
does no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from bureaulake.operators import registry
from bureaulake.shipping import ship
from bureaulake.sources import scratch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def utc(ts: Column) -> Column:
    """Wall-clock time without zone as an instant, whatever the session zone is."""
    return F.concat(ts.cast("string"), F.lit(" UTC")).cast("timestamp")


def utc_day(instant: Column) -> Column:
    """Date text of an instant in UTC, whatever the session zone is."""
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM-dd")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder, in whatever store the session reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a file stream: a folder of parts, or a single file, which only a filter on its folder can stream."""
    path = f"{sf_dir}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    return stream.parquet(path) if is_folder(spark, path) else stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def staged(df: DataFrame, bucket: Column, buckets: int, name: str) -> DataFrame:
    """A table replayed as a stream: bucket 0 arrives first, exactly one bucket per micro-batch.

    The table is evaluated once, into a folder per bucket. What streams is a table of turns, one row in one file per bucket; each
    turn is joined to the stored rows of its bucket, which all tasks read. So neither the number of files nor of rows of a bucket
    decides what a micro-batch holds.
    """
    spark = df.sparkSession
    parts, turns = scratch.folder(spark, f"{name}-parts"), scratch.folder(spark, name)
    df.withColumn("_bucket", bucket.cast("int")).write.partitionBy("_bucket").parquet(parts)
    for i in range(buckets):
        spark.range(i, i + 1, 1, 1).select(F.col("id").cast("int").alias("_turn")).write.mode("append").parquet(turns)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(parts)
    turn = spark.readStream.schema("_turn int").option("maxFilesPerTrigger", 1).parquet(turns).where("_turn >= 0")
    return rows.join(F.broadcast(turn), F.col("_bucket") == F.col("_turn")).select(*df.columns)  # one row


def run(stream: DataFrame, write: Callable[[DataFrame, int, str], None], mode: str, name: str) -> str:
    """Process everything available and return the folder that ``write(batch, batch_id, folder)`` filled."""
    spark = stream.sparkSession
    out, key = scratch.folder(spark, name), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)  # state on disk, not on the heap; a query keeps what it starts with
    try:
        query = (stream.writeStream.outputMode(mode).trigger(availableNow=True)
                 .option("checkpointLocation", scratch.folder(spark, f"{name}-state"))
                 .foreachBatch(lambda batch, batch_id: write(batch, batch_id, out)).start())
        query.awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return out


def append(batch: DataFrame, batch_id: int, folder: str) -> None:
    """One sub-folder per micro-batch: a replay replaces its own rows."""
    batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def rows(stream: DataFrame, name: str) -> DataFrame:
    """Stateless or append-mode stream to a table."""
    return written(stream, run(stream, append, "append", name)).drop("batch_id")


def written(stream: DataFrame, folder: str) -> DataFrame:
    """What a run has written, with its batch; an empty table if nothing came."""
    spark = stream.sparkSession
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest(stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Update-mode aggregation to its current value per key."""
    table = written(stream, run(stream, append, "update", name))
    values = [c for c in table.columns if c not in (*keys, "batch_id")]
    return registry.latest(table, keys, [F.col("batch_id")], values)


def deduplicate(stream: DataFrame, keys: list[str], event_time: str = "ts", delay: str = "1 day") -> DataFrame:
    """First delivery per key within the watermark delay; state older than that is dropped, and so are later rows.

    :func:`late_sink` does the same and keeps the later rows.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def stored_before(batch: DataFrame, schema: T.StructType, folder: str, batch_id: int) -> DataFrame:
    """What earlier micro-batches stored below a folder; an empty table if nothing."""
    spark = batch.sparkSession
    wanted = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(wanted).parquet(folder).filter(F.col("batch_id") < batch_id)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted)


def late_sink(keys: list[str], event_time: str, delay_ms: int) -> Callable[[DataFrame, int, str], None]:
    """Batch writer with a side table: rows later than the watermark go to ``late``, all others once per key to ``rows``.

    The watermark of a batch is the latest event time of the batches before it, less the delay; it is stored with each batch,
    so a replayed batch is split as before. A key counts as delivered while its stored row is no older than the watermark,
    so only the recent part of ``rows`` is looked at. Of equal keys in one batch the earliest row stays.
    """
    def write(batch: DataFrame, batch_id: int, folder: str) -> None:
        known = T.StructType([T.StructField("at_ms", T.LongType())])
        before = stored_before(batch, known, f"{folder}/seen", batch_id).agg(F.max("at_ms").alias("m")).first()["m"]
        at, at_ms = F.col(event_time), F.unix_millis(event_time)
        late = F.lit(False) if before is None else F.coalesce(at_ms < before - delay_ms, F.lit(False))
        batch.filter(late).write.mode("overwrite").parquet(f"{folder}/late/batch_id={batch_id}")
        values = [c for c in batch.columns if c not in keys]
        fresh = registry.first(batch.filter(~late), keys, [at, *[F.col(c) for c in values if c != event_time]], values).select(*batch.columns)
        if before is not None:
            recent = stored_before(batch, batch.schema, f"{folder}/rows", batch_id).filter(at >= F.timestamp_millis(F.lit(before - delay_ms)))
            same = [F.col(f"f.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
            fresh = fresh.alias("f").join(recent.select(*keys).alias("r"), same, "left_anti").select("f.*")
        fresh.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")
        batch.agg(F.max(at_ms).alias("at_ms")).write.mode("overwrite").parquet(f"{folder}/seen/batch_id={batch_id}")

    return write


def audit_sink(keys: list[str], partition: str) -> Callable[[DataFrame, int, str], None]:
    """Batch writer that stores each key once, also when a batch is replayed; ``partition`` is one of ``keys``."""
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")

    def write(batch: DataFrame, batch_id: int, folder: str) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys)
        span = batch.agg(F.min(partition).alias("low"), F.max(partition).alias("high")).first()
        if span["low"] is None:
            return
        try:
            stored = spark.read.parquet(folder).filter(F.col(partition).between(span["low"], span["high"]))  # prunes partitions
            fresh = registry.not_yet_stored(batch, stored, keys)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # nothing stored so far
                raise
        fresh.write.mode("append").partitionBy(partition).parquet(folder)

    return write


# --- two-phase collector -----------------------------------------------------------------------------------

EVENTS = "request_id string, state string, missing string"
PHASE_2 = {"loan_amount", "income_verification"}
PHASE_1 = {"credit_risk", "fraud_detection"}
#: How long a request's state is kept after its last message when no time-out is asked for.
RETENTION_MS = 366 * 86_400_000


def next_step(models: str, selective: bool, label: str | None, flags: dict[str, str | None]) -> str | None:
    """What a request does once these results are there: decide, trigger_phase_2, or nothing yet."""
    if selective:
        return "decide" if set(models.split(",")) <= flags.keys() else None
    if not PHASE_1 <= flags.keys():
        return None
    held = flags["fraud_detection"] == "HIGH" or label in ("DECLINE", "REFER")
    return "decide" if held or PHASE_2 <= flags.keys() else "trigger_phase_2"


#: One request between micro-batches: whether its context has come, the newest flag of each model, how far it has got, when it ends.
REQUEST = ("request_id string, asked boolean, models string, selective boolean, label string, flags map<string,string>, "
           "triggered boolean, done boolean, at_ms long")


@dataclass
class Request:
    """Values in the order of :data:`REQUEST`."""

    request_id: str | None
    asked: bool = False
    models: str | None = None
    selective: bool | None = None
    label: str | None = None
    flags: dict[str, str | None] = field(default_factory=dict)
    triggered: bool = False
    done: bool = False
    at_ms: int = 0


class Collector(StatefulProcessor):
    """The requests of one group: each has its context, the newest flag of each model that has answered, and how far it has got.

    Each transition is emitted once. A deadline per request, moved by every message, ends its state: as a time-out, as results that
    never had a request, or quietly when it was decided. State is read and written once per group and micro-batch instead of once per
    value, and a group's timer is the earliest deadline of its requests.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.requests = handle.getListState("requests", REQUEST)
        self.deadline = handle.getValueState("deadline", "at_ms long")

    def _load(self) -> dict[str | None, Request]:
        found = (Request(*row) for row in self.requests.get())
        return {r.request_id: r for r in found}

    def _store(self, requests: dict[str | None, Request]) -> None:
        if requests:
            self.requests.put([(r.request_id, r.asked, r.models, r.selective, r.label, r.flags, r.triggered, r.done, r.at_ms) for r in requests.values()])
        else:
            self.requests.clear()
        before = self.deadline.get()[0] if self.deadline.exists() else None
        after = min((r.at_ms for r in requests.values()), default=None)
        if after == before:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        if after is None:
            self.deadline.clear()
        else:
            self.deadline.update((after,))
            self.handle.registerTimer(after)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        requests, moved, out = self._load(), {}, []
        columns = ["request_id", "kind", "models", "selective", "label", "model_type", "flag", "at_ms"]
        for frame in rows:
            for request_id, kind, models, selective, label, model, flag, at_ms in frame[columns].itertuples(index=False, name=None):
                request = requests.setdefault(request_id, Request(request_id))
                moved[request_id] = max(moved.get(request_id, 0), int(at_ms))
                if kind == "context":
                    request.asked, request.models, request.selective, request.label = True, models, bool(selective), label
                elif kind == "result":
                    request.flags[model] = flag
        for request_id, latest in moved.items():
            request = requests[request_id]
            found = next_step(request.models, request.selective, request.label, request.flags) if request.asked and not request.done else None
            if found and not (found == "trigger_phase_2" and request.triggered):
                request.triggered, request.done = request.triggered or found == "trigger_phase_2", found == "decide"
                out.append((request_id, found, ""))
            request.at_ms = max(latest + self.timeout_ms, request.at_ms, timerValues.getCurrentWatermarkInMs() + 1)
        self._store(requests)
        yield pd.DataFrame(out, columns=["request_id", "state", "missing"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        requests, out = self._load(), []
        until = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        for request in [r for r in requests.values() if r.at_ms <= until]:
            if not request.asked:  # results after their request had timed out, or without a request
                out.append((request.request_id, "orphan_results", ""))
            elif not request.done:
                out.append((request.request_id, "timeout", ",".join(sorted(set(request.models.split(",")) - request.flags.keys()))))
            del requests[request.request_id]
        self._store(requests)
        yield pd.DataFrame(out, columns=["request_id", "state", "missing"])

    def close(self) -> None:
        pass


def collect(messages: DataFrame, timeout_ms: int = RETENTION_MS, delay: str = "10 minutes", groups: int = 512) -> DataFrame:
    """Transitions of requests from context and result messages.

    ``delay`` must cover the disorder of the messages: what is later than that is dropped. Columns of ``messages``: request_id, kind, models, selective, label, model_type, flag, ts, at_ms.
    ``groups`` is the number of key groups that state is kept in; a task holds the open requests of one group at a time.
    """
    ship(messages.sparkSession)  # the processor's class travels by name
    group = F.pmod(F.xxhash64("request_id"), F.lit(groups)).cast("int")
    keyed = messages.withWatermark("ts", delay).withColumn("_group", group).groupBy("_group")
    return keyed.transformWithStateInPandas(Collector(timeout_ms), EVENTS, "append", "EventTime")


def final_states(transitions: DataFrame) -> DataFrame:
    """Furthest state per request."""
    order = F.array_position(F.array(F.lit("trigger_phase_2"), F.lit("timeout"), F.lit("decide")), F.col("state"))
    return registry.latest(transitions, ["request_id"], [order], ["state"])


