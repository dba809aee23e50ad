"""Near-duplicate vectors by cosine: randomised-rotation binary codes decide which pairs need the exact value.

A vector's code has the signs of its randomly rotated components, and a correction factor: the inner product of the vector with
its code. (rotated query . code) / factor is an unbiased estimate of the cosine, with a known spread; a pair is recomputed in
double precision if its estimate could belong to a cosine at the threshold, and let go otherwise.

Pairs are sought among vectors that agree on all bits of one of several tables (random hyperplanes). Bits and tables follow
from the number of vectors: buckets stay small, and a pair at the threshold is missed with probability MISS. A pair counts in
the first table where it agrees. Large buckets are cut into tiles; within a tile links are counted and its components formed,
no pair leaves the task.

Equal vectors are one class. Null, empty, zero vectors and those with null or non-finite components link with nothing, vectors
of different length neither with each other. Rows with the same vec_id and vector are rows of one class. Null ids stay null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureaulake.llm.common import components, prepare, roots, runs, stored

#: Probability that a pair just at the threshold shares no table, and standard errors that an estimate may be off.
MISS, SLACK = 0.003, 5.0
#: Vectors of a bucket by which bits are chosen, and of one side of a tile.
BUCKET, TILE = 64, 2048
KEYS = "id long, size long, vector binary, code binary, factor double, keys binary"


@cache
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(4242 + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan(n: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(30, max(3, round(np.log2(max(1, n) / BUCKET))))
    agree = (1 - np.arccos(threshold) / np.pi) ** bits
    return bits, max(1, int(np.ceil(np.log(MISS) / np.log1p(-agree))))


@cache
def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(77 + dim).standard_normal((dim, bits * tables))


def _valid(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of each vector that can have a cosine, else null."""
    dtype = np.float64 if kind == "array<double>" else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("embedding").to_pylist():
                if v and None not in v:
                    x = np.array(v, dtype)
                    wide = x.astype(np.float64)
                    out.append(x.tobytes() if np.isfinite(x).all() and 0 < wide @ wide < np.inf else None)
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    return run


def _codes(dtype: type, bits: int, tables: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, factor, keys = [], [], []
            for raw in batch.column("vector").to_pylist():
                x = np.frombuffer(raw, dtype).astype(np.float64)
                x = x / np.linalg.norm(x)
                turned = x @ rotation(len(x))
                code.append(np.packbits(turned > 0).tobytes())
                factor.append(float(np.abs(turned).sum() / np.sqrt(len(x))))
                side = (x @ planes(len(x), bits, tables) > 0).reshape(tables, bits)
                keys.append((side @ (1 << np.arange(bits, dtype=np.int64))).astype(">i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("size"), batch.column("vector"), pa.array(code, pa.binary()), pa.array(factor, pa.float64()),
                                              pa.array(keys, pa.binary())], names=["id", "size", "vector", "code", "factor", "keys"])

    return run


def _links(rows: dict[str, list], table: int, pair: tuple[int, int] | None, dtype: type, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one tile, as two arrays of places: those of pairs that agree on no earlier table."""
    x = np.stack([np.frombuffer(v, dtype) for v in rows["vector"]]).astype(np.float64)
    dim = x.shape[1]
    norm = np.linalg.norm(x, axis=1)
    turned = ((x / norm[:, None]) @ rotation(dim)).astype(np.float32)
    sign = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]]), axis=1)[:, :dim].astype(np.float32) * 2 - 1
    factor = np.array(rows["factor"])
    spread = np.sqrt(np.maximum(0.0, 1 - factor**2) / factor**2 / max(1, dim - 1)) * np.sqrt(1 - threshold**2)
    needed = ((threshold - SLACK * spread) * factor * np.sqrt(dim)).astype(np.float32)
    keys = np.stack([np.frombuffer(k, ">i4") for k in rows["keys"]])
    half = np.array(rows["half"])
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(x), 512):
        at, other = np.nonzero(turned[i : i + 512] @ sign.T >= needed)
        at += i
        keep = at < other if pair is None else (half[at] == pair[0]) & (half[other] == pair[1])
        at, other = at[keep], other[keep]
        for k in range(0, len(at), 1 << 16):
            a, b = at[k : k + (1 << 16)], other[k : k + (1 << 16)]
            if table:
                fresh = ~(keys[a, :table] == keys[b, :table]).any(1)
                a, b = a[fresh], b[fresh]
            close = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= threshold
            left.append(a[close])
            right.append(b[close])
    return np.concatenate(left), np.concatenate(right)


def _tiles(dtype: type, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by tile to (id, links, root): what each tile adds to a vector's links, and where it connects it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (table, _, _, first, second), rows in runs(batches, ["table", "dim", "key", "first", "second"], ["id", "size", "vector", "code", "factor", "keys", "half"]):
            if len(rows["id"]) < 2:
                continue
            a, b = _links(rows, table, None if first == second else (first, second), dtype, threshold)
            if len(a) == 0:
                continue
            ids, size = np.array(rows["id"]), np.array(rows["size"])
            count = np.bincount(a, size[b], len(ids)) + np.bincount(b, size[a], len(ids))
            some = np.flatnonzero(count)
            root = ids[roots(len(ids), a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(count[some].astype(np.int64)), pa.array(root[some])], names=["id", "links", "root"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding)."""
    prepare(vectors.sparkSession)
    kind = vectors.select("embedding").dtypes[0][1]
    dtype = np.float64 if kind == "array<double>" else np.float32
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_valid(kind), "vec_id long, vector binary"), "vectors")
    usable = rows.where("vec_id is not null and vector is not null")
    classes = usable.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    bits, tables = plan(classes.count(), threshold)
    coded = stored(classes.select("id", "size", "vector").mapInArrow(_codes(dtype, bits, tables), KEYS), "codes")
    # keys are big-endian, so that their hex digits are the number; Spark reverses binary values by characters
    key = F.conv(F.hex(F.expr("substring(keys, 4 * table + 1, 4)")), 16, 10).cast("long")
    buckets = coded.withColumn("table", F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))).withColumns({"key": key, "dim": F.octet_length("vector")})
    sizes = buckets.groupBy("table", "dim", "key").agg(F.count("*").alias("n")).where("n > 1")
    cut = F.ceil(F.col("n") / TILE).cast("int")
    shared = buckets.join(sizes, ["table", "dim", "key"]).withColumn("half", F.pmod(F.xxhash64("id"), cut).cast("int"))
    tiled = shared.withColumn("other", F.explode(F.sequence(F.lit(0), cut - 1))).select(
        "table", "dim", "key", F.least("half", "other").alias("first"), F.greatest("half", "other").alias("second"), "id", "size", "vector", "code", "factor", "keys", "half")
    tile = ["table", "dim", "key", "first", "second"]
    found = stored(tiled.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_tiles(dtype, threshold), "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found, "id", "root").withColumnRenamed("node", "id")
    placed = classes.join(links, "id", "left").join(joined, "id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.withColumn("usable", F.when(F.col("vec_id").isNotNull(), F.col("vector"))).join(placed.withColumnRenamed("vector", "usable"), "usable", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
