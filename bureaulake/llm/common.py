"""What the operators share: tables, folds, stored intermediates, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake.shipping import ship
from bureaulake.sources import scratch

#: Bytes of text that Spark hands to a Python worker at once.
BATCH_BYTES = 16 << 20
#: Edges of a graph that a task joins up at once.
EDGES = 1 << 19


def prepare(spark: SparkSession) -> SparkSession:
    """Ships the package to the executors and bounds Arrow batches by bytes, so that very long texts don't pile up."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1))) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written below the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch.folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_where(docs: DataFrame, decide: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows for whose ``text`` the decision is true, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(decide(batch.column("text"))))

    return docs.mapInArrow(run, docs.schema)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def groups_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Joins batches until ``limit`` bytes of ``column`` are reached, so that dictionaries cover many documents."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Returns what this worker has freed to the machine. Workers are used again, and would keep the most they ever needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def runs(batches: Iterator[pa.RecordBatch], key: list[str], columns: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """(key, columns as lists) of each run of rows with equal keys, also across batches; the rows are sorted by key."""
    held: dict[str, list] = {}
    current = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
        values = [batch.column(c).to_pylist() for c in columns]
        i = 0
        while i < len(keys):
            j = i
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
            if keys[i] != current:
                if current is not None:
                    yield current, held
                held, current = {c: [] for c in columns}, keys[i]
            for c, v in zip(columns, values, strict=True):
                held[c] += v[i:j]
            i = j
    if current is not None:
        yield current, held


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of 0..n-1 that each one is connected with."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _joined(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Edges (u, v) to one for each of their nodes, to the smallest node it reaches by them: by ``limit`` edges of a task at a time."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        edges = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate([edges.column(c).to_numpy() for c in "uv"]), return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[roots(len(nodes), at[: len(edges)], at[len(edges) :])])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= limit:
                yield stars(held)
                held, size = [], 0
        if held:
            yield stars(held)

    return run


def components(edges: DataFrame, a: str, b: str, name: str = "components", limit: int = EDGES) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    First each task joins up the edges it has, ``limit`` at a time, of which there are as many tasks as there are such portions; if
    there is one portion, that is all. Else alternating large-star and small-star steps follow until every node has one edge, to a
    node that has none itself. A hub's neighbours are never gathered: each step takes a minimum with partial aggregation and joins it
    back, where AQE may split a hub. Every round is written to the shared folder.
    """
    pairs = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")), name)
    n = pairs.count()
    joined = pairs.coalesce(max(1, -(-n // limit))).mapInArrow(_joined(limit), "u long, v long")
    if n <= limit:
        return stored(joined.withColumnsRenamed({"u": "node", "v": "component"}), name)
    pairs = stored(joined.where("u != v").distinct(), name)
    while True:
        ends = pairs.select(F.col("u").alias("node"), "v").unionAll(pairs.select("v", F.lit(None).cast("long"))).groupBy("node").agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("ends"), F.count("v").alias("up"))
        if ends.where((F.col("low") != F.col("high")) | (F.col("up").between(1, F.col("ends") - 1))).isEmpty():
            break
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), name)
    tops = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        tops.select("node", F.col("node").alias("component")))
