"""Byte-level BPE by the ranks of a vocabulary file, and decoding.

Pre-tokens travel with their positions in blocks of documents; each distinct one is merged once, wherever it stands, its ids go
back to the blocks and are put together by position. Decoding joins the table of the tokens' bytes, which has one row per id
of the vocabulary and is as large whatever the corpus.

Null texts count as empty: no ids, and the digest of no bytes. Repeated rows and null ids are kept as they are. The text's
bytes must be UTF-8; decoded bytes equal them exactly, provided that the vocabulary has all 256 single bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import blocks, pretokens
from bureaulake.llm.common import prepare

#: Ids put together at once.
SLICE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged, leftmost first, until none has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 200:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == _NONE:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


_NONE = 1 << 40


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, for words whose length squared would hurt."""
    end = list(range(1, len(word) + 1))  # of the part that begins at a place; 0 where none does
    begin = list(range(len(word)))  # of the part that ends just before place + 1
    heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, k = heapq.heappop(heap)
        j = end[i]
        if j == 0 or j >= len(word) or end[j] != k:
            continue
        end[i], end[j], begin[k - 1] = k, 0, i
        if i:
            h = begin[i - 1]
            if (r := ranks.get(word[h:k])) is not None:
                heapq.heappush(heap, (r, h, k))
        if k < len(word) and (r := ranks.get(word[i : end[k]])) is not None:
            heapq.heappush(heap, (r, i, end[k]))
    out, i = [], 0
    while i < len(word):
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _encode_words(ranks: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in batches:
            payloads = []
            for words, payload in zip(batch.column("words").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if words:
                    found = []
                    for word in blocks.words_of(payload)[0]:
                        ids = known.get(word)
                        if ids is None:
                            ids = known[word] = np.array(merge(word, ranks), np.uint32).tobytes()
                        found.append(ids)
                    payload = blocks.pack(np.array([len(i) // 4 for i in found], np.uint32), np.frombuffer(b"".join(found), np.uint32))
                payloads.append(payload)
            yield batch.set_column(batch.schema.get_field_index("payload"), "payload", pa.array(payloads, pa.binary()))

    return run


def ids_of(block: blocks.Block, answers: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end document, ids, offsets) of runs of the block's documents."""
    parts = [blocks.unpack(a) for a in answers]
    size = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint32)
    flat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint32)
    at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    place = block.place()[block.words]
    total = np.concatenate([[0], np.cumsum(size[place], dtype=np.int64)])[block.first]
    i, n = 0, len(block.n)
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE, "right")) - 1)
        yield i, j, blocks.take(flat, at, place[block.first[i] : block.first[j]]), total[i : j + 1] - total[i]
        i = j


def _finish(tokens_of: list[bytes]) -> Callable[[blocks.Block, list[bytes]], pa.Table]:
    def run(block: blocks.Block, answers: list[bytes]) -> pa.Table:
        spelled = [str(i).encode() for i in range(len(tokens_of))]
        counts, ids_digest, decoded_digest = [], [], []
        for i, j, ids, offsets in ids_of(block, answers):
            for k in range(j - i):
                own = ids[offsets[k] : offsets[k + 1]].tolist()
                counts.append(len(own))
                ids_digest.append(hashlib.sha256(b" ".join(map(spelled.__getitem__, own))).hexdigest())
                decoded_digest.append(hashlib.sha256(b"".join(map(tokens_of.__getitem__, own))).hexdigest())
        return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                         "ids_sha256": pa.array(ids_digest, pa.string()), "decoded_sha256": pa.array(decoded_digest, pa.string())})

    return run


def _listed(block: blocks.Block, answers: list[bytes]) -> pa.Table:
    ids = [ids[offsets[k] : offsets[k + 1]] for i, j, ids, offsets in ids_of(block, answers) for k in range(j - i)]
    return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))})


def _encoded(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    prepare(docs.sparkSession)
    cut = blocks.cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), pretokens.pretokens)
    return blocks.dealt(cut).mapInArrow(_encode_words(ranks), blocks.SCHEMA)


def encode(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id and its ids, for each row of (doc_id, text)."""
    return blocks.assemble(_encoded(docs, ranks), _listed, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id and decoded bytes, from (doc_id, ids)."""
    prepare(encoded.sparkSession)
    tokens_of = token_bytes(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if ids is None else b"".join(map(tokens_of.__getitem__, ids)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def round_trip(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of (doc_id, text): encoded, then decoded from the ids alone."""
    return blocks.assemble(_encoded(docs, ranks), _finish(token_bytes(ranks)),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
