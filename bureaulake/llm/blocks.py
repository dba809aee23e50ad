"""Words of a corpus that travel once per block of documents instead of once per occurrence.

A block is a run of documents of bounded size. Its documents are kept as positions: for each document the places of its words in
the block's own word list. The word lists are dealt out by a hash of the word, so that all blocks' copies of a word meet in
one partition, where something is found out about each distinct word once; the answers go back to their blocks and the
documents are put together again by position. A word that every document has costs one entry per block.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import tokens
from bureaulake.llm.common import groups_of, partitions

#: Bytes of text of a block; a longer text is a block of its own.
BLOCK = 16 << 20
SCHEMA = "block long, bucket int, words boolean, payload binary"
ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.bool_()), ("payload", pa.binary())])

#: Cuts texts: (bytes, offsets) to (bytes, starts, ends, where each text's words begin).
Cutter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def pack(*arrays: np.ndarray | list | None) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, 5), 3)


def unpack(payload: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(payload))


def spread(numbers: np.ndarray) -> list[np.ndarray]:
    """Numbers as byte streams that pack well when small ones are frequent: the first byte of each, and what follows it by kind."""
    top, low = numbers >> 20, numbers & 0xFFFFF
    two, three = (low >= 192) & (low < 12480), low >= 12480
    second, third = low[two] - 192, low[three] - 12480
    first = np.where(two, 192 + ((low - 192) >> 8), np.where(three, 240 + ((low - 12480) >> 16), low))
    return [x.astype(np.uint8) for x in (first, second & 255, (third >> 8) & 255, third & 255)] + [top.astype(np.uint16) if top.any() else None]


def gathered(streams: list[np.ndarray]) -> np.ndarray:
    """What ``spread`` was given."""
    first, second, middle, last, top = streams
    out = first.astype(np.int64)
    two, three = (first >= 192) & (first < 240), first >= 240
    out[two] = ((out[two] - 192) << 8) + second + 192
    out[three] = ((out[three] - 240) << 16) + (middle.astype(np.int64) << 8) + last + 12480
    return out if top is None else out + (top.astype(np.int64) << 20)


def slices(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The given slices one after the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def take(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Of ragged rows, the chosen ones one after the other."""
    return slices(flat, offsets[which], offsets[which + 1] - offsets[which])


def _cut(cutter: Cutter, buckets: int, block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for table in groups_of(batches, "text", block_bytes):
            for rows in _pieces(table, block_bytes):
                columns = _block(rows, cutter, buckets, (part << 24) + count)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types, strict=True)], schema=ARROW)
                count += 1

    return run


def _pieces(table: pa.Table, limit: int) -> Iterator[pa.Table]:
    for i, j, _, _ in tokens.chunks(table.column("text"), limit):
        yield table.slice(i, j - i)


def _block(table: pa.Table, cutter: Cutter, buckets: int, seed: int) -> tuple[list, list, list, list]:
    hashes, sizes, where, counts, kept = [], [], [], [], []
    for _, _, data, offsets in tokens.chunks(table.column("text")):
        data, starts, ends, first = cutter(data, offsets)
        hashes.append(tokens.span_hashes(data, starts, ends))
        kept.append((data, starts, ends))
        counts.append(np.diff(first))
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    codes, keys = pd.factorize(h)
    often = np.bincount(codes, minlength=len(keys))
    order = np.argsort(-often, kind="stable")  # frequent words get low numbers, which pack well
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.arange(len(keys), dtype=np.int32)
    keys = np.asarray(keys, np.uint64)[order]
    # the bytes of each distinct word, from where it stands first
    first = np.flatnonzero(codes > np.maximum.accumulate(np.append(-1, codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    begin, sizes, where = 0, [], []
    for data, starts, ends in kept:
        own = first[(first >= begin) & (first < begin + len(starts))] - begin
        sizes.append(ends[own] - starts[own])
        where.append(slices(data, starts[own], sizes[-1]))
        begin += len(starts)
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    text = np.concatenate(where) if where else np.zeros(0, np.uint8)
    at = np.concatenate([[0], np.cumsum(size)])
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.uint8 if buckets <= 256 else np.uint16)
    seq = rank[codes].astype(np.int64)
    training = table.column("training").to_pylist() if "training" in table.schema.names else None
    if training is not None:  # how often each word occurs in training texts
        seen = np.bincount(seq[np.repeat(np.array(training, bool), n)], minlength=len(keys))
    docs = pack(table.column("doc_id").to_pylist(), training, n.astype(np.uint32), spread(seq), bucket)
    block = int(np.int64(xxhash.xxh3_64_intdigest(docs, seed).__rshift__(1)))
    out = ([block], [block % buckets], [False], [docs])
    sorted_words = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[sorted_words], np.arange(buckets + 1))
    for b in range(buckets):
        mine = sorted_words[bounds[b] : bounds[b + 1]]
        if len(mine):
            word = order[mine]  # place among the distinct words by first occurrence
            for column, value in zip(out, (block, b, True, pack(size[word].astype(np.uint32), take(text, at, word), None if training is None else seen[mine].astype(np.uint32))), strict=True):
                column.append(value)
    return out


def cut(docs: DataFrame, cutter: Cutter, block_bytes: int = BLOCK) -> DataFrame:
    """Rows of blocks: one of documents, and one for each bucket of the words. docs: doc_id, text and perhaps training."""
    buckets = min(60_000, max(16, 2 * partitions(docs.sparkSession)))
    return docs.mapInArrow(_cut(cutter, buckets, block_bytes), SCHEMA)


def words_of(payload: bytes) -> tuple[list[bytes], np.ndarray | None]:
    """A bucket's words and their counts in training texts."""
    size, text, seen = unpack(payload)
    text, ends = text.tobytes(), np.cumsum(size).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)], seen


class Block:
    """The documents of one block and, by ``answers``, what has been found out about its words."""

    def __init__(self, payload: bytes):
        self.doc_ids, self.training, self.n, streams, self.bucket = unpack(payload)
        self.words = gathered(streams)
        self.first = np.concatenate([[0], np.cumsum(self.n, dtype=np.int64)])

    def place(self) -> np.ndarray:
        """For each word of the block, its row among the answers of all buckets one after the other."""
        place = np.empty(len(self.bucket), np.int64)
        place[np.argsort(self.bucket, kind="stable")] = np.arange(len(self.bucket))
        return place


def assemble(rows: DataFrame, finish: Callable[[Block, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """Brings each block's documents and its buckets' answers together; ``finish`` gets the answers in the order of buckets."""

    def run(group: pa.Table) -> pa.Table:
        answers, blocks = {}, []
        for bucket, words, payload in zip(*(group.column(c).to_pylist() for c in ("bucket", "words", "payload")), strict=True):
            if words:
                answers[bucket] = payload
            else:
                blocks.append(payload)
        ordered = [answers[b] for b in sorted(answers)]
        return pa.concat_tables([finish(Block(payload), ordered) for payload in blocks])

    return rows.groupBy("block").applyInArrow(run, schema)


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.col("bucket"))
