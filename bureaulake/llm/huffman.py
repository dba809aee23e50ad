"""Token ids as canonical, length-limited Huffman code in blocks that can be read alone.

A stored file is a table with one row per block: its place (part, block), how many ids it has, their bits, a bit offset for every
CHECKPOINT ids (kept as differences) and the ids and counts of its documents. Blocks are in ascending order of doc_id and hold
whole documents, at least BLOCK_IDS ids unless they are the last of their part. One more row, with part -1, holds the code
lengths of all ids, from which the code follows. The code is built on global counts. Decoding looks up LIMIT bits at a time
in one table and goes on from all checkpoints of a block at once.

Null and empty texts have the end id alone. Repeated ids and rows are kept, beside each other. Rows without doc_id come first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bureaulake.llm import blocks, pretokens, tokens
from bureaulake.llm.common import partitions, prepare, stored
from bureaulake.sources import scratch

BLOCK_IDS = 1 << 20
CHECKPOINT = 64
#: Longest code in bits; more only if there are more ids than that tells apart.
LIMIT = 16
#: Distinct pre-tokens a worker remembers before it starts anew, words encoded in one go, and bytes of text handled at once.
REMEMBER, AT_ONCE, TEXT = 1_500_000, 1000, 4 << 20
FILE = "part int, block long, n long, bits binary, checkpoints binary, documents binary"


# ---- ids


class Met:
    """Ids of the pre-tokens a worker has met: sorted hashes, and where each one's ids begin and how many they are."""

    def __init__(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, or where it belongs; whether it is there)."""
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.keys, keys[order])
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == keys[there]
        return at, there

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Takes in keys that are not there, each with so many of the ids."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        self.used += len(ids)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.starts = np.insert(self.keys, at, keys[order]), np.insert(self.starts, at, starts[order])
        self.sizes = np.insert(self.sizes, at, sizes[order])


@cache
def tokenizer(path: str) -> tuple[Tokenizer, np.ndarray, list[Met]]:
    """The tokenizer, which of its tokens begin with a blank, and the pre-tokens this worker has met."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks have the cores
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    blank = np.zeros(t.get_vocab_size(), bool)
    for token, i in t.get_vocab().items():
        blank[i] = token.startswith("Ġ")
    return t, blank, [Met()]


def _learn(path: str, keys: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> None:
    """Encodes distinct pre-tokens, given one after the other. Those of a blank and something else are strung together: each begins
    a pre-token anywhere."""
    t, blank, (met,) = tokenizer(path)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    blanks = np.concatenate([[0], np.cumsum(text == 32)])
    strung = (sizes > 1) & (text[starts] == 32) & (blanks[ends] - blanks[starts] == 1)
    strung[strung] = ~tokens.BLANK[text[starts[strung] + 1]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    which = np.flatnonzero(strung)
    line, line_ends = blocks.slices(text, starts[which], sizes[which]).tobytes(), np.append(0, np.cumsum(sizes[which]))
    runs = [(i, min(i + AT_ONCE, len(which))) for i in range(0, len(which), AT_ONCE)]
    for (i, j), coded in zip(runs, t.encode_batch_fast([line[line_ends[i] : line_ends[j]].decode() for i, j in runs], add_special_tokens=False), strict=True):
        ids = np.array(coded.ids, np.uint32)
        at = np.flatnonzero(blank[ids])
        if len(at) == j - i and at[0] == 0:
            found.append((keys[which[i:j]], np.diff(at, append=len(ids)), ids))
        else:
            strung[which[i:j]] = False
    alone = np.flatnonzero(~strung)
    whole = text.tobytes()
    coded = t.encode_batch_fast([whole[a:b].decode() for a, b in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)], add_special_tokens=False)
    if len(alone):
        each = [np.array(c.ids, np.uint32) for c in coded]
        found.append((keys[alone], np.array([len(x) for x in each], np.int64), np.concatenate(each)))
    met.add(*(np.concatenate(x) for x in zip(*found, strict=True)))


def encode(column: pa.Array | pa.ChunkedArray, path: str, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets) of runs of texts; each text's ids are followed by ``end``."""
    known = tokenizer(path)[2]
    for i, j, data, offsets in tokens.chunks(column, TEXT):
        n, parts = j - i, []
        for a, b, some, where in tokens.chunks(pa.chunked_array([column.slice(i, n)]) if isinstance(column, pa.Array) else column.slice(i, n)):
            some, starts, ends, first = pretokens.pretokens(some, where)
            parts.append((some, starts, ends, np.diff(first), tokens.span_hashes(some, starts, ends)))
        h = np.concatenate([p[4] for p in parts])
        count = np.concatenate([p[3] for p in parts])
        codes, keys = pd.factorize(h)
        keys = np.asarray(keys, np.uint64)
        if len(known[0].keys) > REMEMBER:
            known[0] = Met()
        place, there = known[0].find(keys)
        if not there.all():
            first = np.flatnonzero(codes > np.maximum.accumulate(np.append(-1, codes[:-1])))[~there]
            sizes, text, begin = [], [], 0
            for some, starts, ends, _, _ in parts:
                own = first[(first >= begin) & (first < begin + len(starts))] - begin
                sizes.append(ends[own] - starts[own])
                text.append(blocks.slices(some, starts[own], sizes[-1]))
                begin += len(starts)
            _learn(path, keys[~there], np.concatenate(text), np.concatenate(sizes))
            place, _ = known[0].find(keys)
        met = known[0]
        size = met.sizes[place][codes].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])] if len(codes) else np.zeros(n + 1, np.int64)
        length = np.diff(total)
        ends_at = np.concatenate([[0], np.cumsum(length + 1)])
        ids = np.full(ends_at[-1], end, np.uint32)
        body = np.ones(len(ids), bool)
        body[ends_at[1:] - 1] = False
        if len(codes):
            ids[body] = blocks.slices(met.ids, met.starts[place][codes], size)
        yield i, j, ids, ends_at


def _collect(path: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of ids in the order of the rows, and how often each id occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, seen = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)
        doc_ids: list = []
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            low, high, top = (ids & 255).astype(np.uint8), ((ids >> 8) & 255).astype(np.uint8), (ids >> 16).astype(np.uint8)
            return _rows([part], [block], [len(ids)], [blocks.pack(low, high, top)], [blocks.pack(doc_ids, np.concatenate(counts).astype(np.uint32))])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for i, j, ids, offsets in encode(batch.column("text"), path, end):
                found = np.bincount(ids)
                seen = np.pad(seen, (0, max(0, len(found) - len(seen))))
                seen[: len(found)] += found
                a = i
                while a < j:  # a block ends behind the document that fills it
                    b = min(j, i + int(np.searchsorted(offsets, offsets[a - i] + BLOCK_IDS - size, "left")))
                    b = max(b, a + 1)
                    doc_ids += names[a:b]
                    held.append(ids[offsets[a - i] : offsets[b - i]])
                    counts.append(np.diff(offsets[a - i : b - i + 1]))
                    size += len(held[-1])
                    if size >= BLOCK_IDS:
                        yield flush()
                        doc_ids, held, counts, size, block = [], [], [], 0, block + 1
                    a = b
        if held:
            yield flush()
        some = np.flatnonzero(seen)
        yield _rows([None] * len(some), some.tolist(), seen[some].tolist(), [None] * len(some), [None] * len(some))

    return run


def _rows(part: list, block: list, n: list, ids: list, documents: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                                       pa.array(documents, pa.binary())], names=["part", "block", "n", "ids", "documents"])


# ---- the code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the best prefix code with at most ``limit`` bits (package-merge); 0 for what doesn't occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    leaves, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weight, packages])
        by = np.argsort(both, kind="stable")
        leaves.append(by < len(weight))
        both = both[by]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take, size = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for leaf in reversed(leaves):
        m = int(leaf[:take].sum())
        size[:m] += 1
        take = 2 * (take - m)
    lengths[order] = size
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter codes first, and by id among equal lengths."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    size = lengths[order].astype(np.int64)
    longest = int(size.max(initial=1))
    step = (1 << (longest - size)).astype(np.uint64)  # in units of the longest code
    codes[order] = (np.cumsum(step) - step) >> (longest - size).astype(np.uint64)
    return codes


def lookup(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of all bit strings as long as the longest code: the id they begin with and its code's length."""
    used = np.flatnonzero(lengths)
    longest = int(lengths.max(initial=1))
    order = used[np.argsort(lengths[used], kind="stable")]
    span = 1 << (longest - lengths[order].astype(np.int64))
    ids, size = np.zeros(1 << longest, np.uint32), np.zeros(1 << longest, np.int64)
    full = int(span.sum())
    ids[:full], size[:full] = np.repeat(order, span), np.repeat(lengths[order].astype(np.int64), span)
    return ids, size, longest


def write_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes one after the other, and the bit offset of every CHECKPOINT-th."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word = at >> 5
    value = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    out = np.zeros(int(ends[-1] // 32) + 3, np.uint64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    out[word[first]] = np.add.reduceat(value >> np.uint64(32), first)  # codes don't overlap, so sums don't carry
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes(), at[::CHECKPOINT]


def read_bits(bits: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    symbol, size, longest = table
    words = np.frombuffer(bits, ">u4").astype(np.uint64)
    out = np.zeros((len(checkpoints), CHECKPOINT), np.uint32)
    at = checkpoints.astype(np.int64)
    mask = np.uint64((1 << longest) - 1)
    last = n - (len(checkpoints) - 1) * CHECKPOINT
    for k in range(CHECKPOINT):
        if k == last:  # the last checkpoint may have fewer
            at = at[:-1]
        if len(at) == 0:
            break
        word = at >> 5
        window = ((words[word] << np.uint64(32)) | words[word + 1]) >> (64 - longest - (at & 31)).astype(np.uint64) & mask
        out[: len(at), k] = symbol[window]
        at = at + size[window]
    return out.reshape(-1)[:n]


# ---- on Spark


def _write(lengths: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    codes = canonical(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, marks = [], []
            for payload in batch.column("ids").to_pylist():
                low, high, top = blocks.unpack(payload)
                ids = low.astype(np.uint32) | (high.astype(np.uint32) << 8) | (top.astype(np.uint32) << 16)
                coded, at = write_bits(ids, codes, lengths)
                bits.append(coded)
                marks.append(np.diff(at, prepend=0).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("block"), batch.column("n"), pa.array(bits, pa.binary()), pa.array(marks, pa.binary()),
                                              batch.column("documents")], names=["part", "block", "n", "bits", "checkpoints", "documents"])

    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, end: int) -> None:
    """Encodes every row of (doc_id, text) and writes the file."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    found = stored(ordered.mapInArrow(_collect(tokenizer_path, end), "part int, block long, n long, ids binary, documents binary"), "ids")
    counted = found.where("part is null").groupBy("block").agg(F.sum("n").alias("n")).collect()  # one row per id of the vocabulary
    counts = np.zeros(max((r["block"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r["block"]] = r["n"]
    lengths = code_lengths(counts)
    code = spark.createDataFrame([(-1, 0, len(lengths), bytearray(lengths.tobytes()), None, None)], FILE)
    found.where("part is not null").mapInArrow(_write(lengths), FILE).unionAll(code).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, block, place (among the block's documents), at (ids of the block before it) and ids, from a written file."""
    prepare(spark)

    def run(ids: np.ndarray, names: list, counts: np.ndarray, part: int, block: int) -> dict:
        ends = np.cumsum(counts, dtype=np.int64)
        return {"ids": [ids[b - c : b].astype(np.int32) for b, c in zip(ends, counts, strict=True)]}

    return _decoded(spark, path, run, [("ids", pa.list_(pa.int32()))], "ids array<int>")


def _decoded(spark: SparkSession, path: str, more: Callable, fields: list, schema: str) -> DataFrame:
    file = spark.read.schema(FILE).parquet(path)
    lengths = np.frombuffer(bytes(file.where("part = -1").select("bits").first()["bits"]), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup(lengths)
        for batch in batches:
            for part, block, n, bits, marks, documents in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                ids = read_bits(bits, np.cumsum(np.frombuffer(marks, np.uint16), dtype=np.int64), n, table)
                names, counts = blocks.unpack(documents)
                found = more(ids, names, counts, part, block)
                m = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(np.full(m, part, np.int32)), pa.array(np.full(m, block, np.int64)),
                     pa.array(np.cumsum(counts, dtype=np.int64) - counts), pa.array(counts.astype(np.int64)), *(pa.array(found[k], t) for k, t in fields)],
                    names=["doc_id", "part", "block", "at", "n_tokens", *(k for k, _ in fields)])

    return file.where("part >= 0").mapInArrow(run, f"doc_id long, part int, block long, at long, n_tokens long, {schema}")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, before): ids in all blocks before each one. First by part, then within the part: no task sees all blocks."""
    file = spark.read.schema(FILE).parquet(path).where("part >= 0").select("part", "block", "n")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = file.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("parts"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return file.join(parts, "part").select("part", "block", (F.col("parts") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in a written file, from its decoded ids."""
    prepare(spark)

    def sums(ids: np.ndarray, names: list, counts: np.ndarray, part: int, block: int) -> dict:
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts, dtype=np.int64) * 4
        return {"ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]}

    found = _decoded(spark, path, sums, [("ids_crc32", pa.int64())], "ids_crc32 long")
    return found.join(starts(spark, path), ["part", "block"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def archive(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """Writes the file below the shared folder and reads it back: doc_id, start, n_tokens, ids_crc32."""
    path = scratch.folder(docs.sparkSession, "huffman")
    write(docs, path, tokenizer_path, end)
    return index(docs.sparkSession, path)
