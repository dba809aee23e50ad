"""Probability of texts under a subword lattice: all segmentations of a word into pieces of an existing vocabulary count, each
with the product of its pieces' probabilities, summed in log space by the forward recursion.

The vocabulary's own scores order its pieces and give their prior (Zipf's law over that order). Words of the training texts are
one more way through their lattice: an edge over the whole word, with its count less a discount that all training words give
(by the counts of words seen once and twice). What they give goes to the pieces, by the expected piece counts of each distinct
training word's lattice, from forward and backward recursion. A text is its words, each with a begin mark, then an end:
pieces with the mark begin a word, all others continue it. Characters that no piece spells go byte by byte. So the
probabilities of all texts sum to at most one, and unseen words have the probability of being spelled.

Each distinct word is looked at once, wherever it stands (see blocks). Null, empty and blank texts are the end alone. Without
training texts the prior holds, and every base count is 0. Repeated rows and null ids are kept as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import blocks, pretokens, tokens
from bureaulake.llm.common import prepare, stored

MARK = "▁"
_MARK = np.frombuffer(MARK.encode(), np.uint8)
#: Rounds of re-estimation, and how many pieces the prior counts as.
ROUNDS, PRIOR = 3, 1000.0
#: Words whose lattices are held at once; fewer if they are long.
AT_ONCE = 20_000
NONE = -1e30


@dataclass
class Vocabulary:
    """Sorted hashes of the pieces that begin a word (without the mark) and of those that continue it, with their numbers."""

    begin: tuple[np.ndarray, np.ndarray]
    inner: tuple[np.ndarray, np.ndarray]
    begin_sizes: list[int]
    inner_sizes: list[int]
    byte: np.ndarray
    #: Of the begin mark alone.
    mark: int
    prior: np.ndarray


def read(path: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    scores = np.array([model.get_score(i) for i in range(n)])
    kinds: dict[bool, dict[bytes, int]] = {True: {}, False: {}}
    byte = np.zeros(256, np.int64)
    usable = np.zeros(n, bool)
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(piece[1:-1], 16)] = i
            usable[i] = True
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            begins = piece.startswith(MARK)
            rest = piece[len(MARK):] if begins else piece
            if MARK not in rest and not tokens.BLANK[list(rest.encode())].any():
                kinds[begins][rest.encode()] = i
                usable[i] = True
    order = np.argsort(-scores[usable], kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    prior = np.zeros(n)
    prior[usable] = 1 / (10 + rank)
    prior[byte] = prior[usable].min() / 256

    def sorted_hashes(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = tokens.text_bytes(pa.array(list(pieces), pa.binary()).cast(pa.string()))
        h, number = tokens.span_hashes(data, offsets[:-1], offsets[1:]), np.array(list(pieces.values()), np.int64)
        by = np.argsort(h)
        return h[by], number[by]

    mark = kinds[True].pop(b"")
    begin, inner = kinds[True], kinds[False]
    return Vocabulary(sorted_hashes(begin), sorted_hashes(inner), sorted({len(p) for p in begin}), sorted({len(p) for p in inner}), byte, mark,
                      prior / prior.sum())


def _find(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Number of the piece with each hash, or -1."""
    at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
    return np.where(table[0][at] == h, table[1][at], -1)


class Lattice:
    """Edges of words of one length: for each begin, its pieces as (end, numbers per word; -1 where none)."""

    def __init__(self, v: Vocabulary, words: np.ndarray):
        self.v, self.words = v, words
        n, size = words.shape
        up, down = tokens.powers(size + 1)
        total = np.zeros((n, size + 1), np.uint64)
        np.cumsum(tokens._VALUES[words] * up[:size], axis=1, out=total[:, 1:])
        lead = (words & 0xC0) != 0x80
        width = np.where(words < 0xC0, 1, np.where(words < 0xE0, 2, np.where(words < 0xF0, 3, 4)))
        self.edges: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(size)]
        self.first: list[tuple[int, np.ndarray]] = []
        self.spelled: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(size)]

        def found(table: tuple[np.ndarray, np.ndarray], i: int, k: int) -> np.ndarray:
            h = tokens.mix((total[:, i + k] - total[:, i]) * down[i] + np.uint64(k * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
            if k > tokens.LONG_SPAN:
                h = tokens.span_hashes(np.ascontiguousarray(words[:, i : i + k]).reshape(-1), np.arange(n) * k, np.arange(1, n + 1) * k)
            return _find(table, h)

        for k in v.begin_sizes:
            if k <= size and (number := found(v.begin, 0, k)).max(initial=-1) >= 0:
                self.first.append((k, number))
        for i in range(size):
            single = np.zeros(n, bool)
            for k in v.inner_sizes:
                if i + k > size:
                    break
                number = found(v.inner, i, k)
                if number.max(initial=-1) >= 0:
                    self.edges[i].append((i + k, number))
                    single |= (number >= 0) & (width[:, i] == k)
            for k in range(1, min(4, size - i) + 1):
                alone = lead[:, i] & ~single & (np.minimum(width[:, i], size - i) == k)
                if alone.any():
                    self.spelled[i].append((i + k, alone))

    def _edges(self, i: int, log: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        padded = np.append(log, NONE)
        for end, number in self.edges[i]:
            yield end, padded[number], number
        for end, alone in self.spelled[i]:
            spelled = log[self.v.byte][self.words[:, i:end]].sum(1)
            yield end, np.where(alone, spelled, NONE), None

    def forward(self, log: np.ndarray) -> np.ndarray:
        """Log weight of all ways to each place; the last is the word's probability."""
        n, size = self.words.shape
        ways = np.full((n, size + 1), NONE)
        ways[:, 0] = log[self.v.mark]
        padded = np.append(log, NONE)
        for end, number in self.first:
            ways[:, end] = np.logaddexp(ways[:, end], padded[number])
        for i in range(size):
            for end, weight, _ in self._edges(i, log):
                ways[:, end] = np.logaddexp(ways[:, end], ways[:, i] + weight)
        return ways

    def expected(self, log: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of each piece in the words, each taken ``counts`` times."""
        n, size = self.words.shape
        ways = self.forward(log)
        rest = np.full((n, size + 1), NONE)
        rest[:, size] = 0.0
        out, padded = np.zeros(len(log)), np.append(log, NONE)

        def add(number: np.ndarray, level: np.ndarray) -> None:
            share = np.where(number >= 0, np.exp(np.minimum(level - ways[:, size], 0.0)) * counts, 0.0)
            out[:] += np.bincount(np.maximum(number, 0), share, len(log))

        for i in range(size - 1, -1, -1):
            for end, weight, _ in self._edges(i, log):
                rest[:, i] = np.logaddexp(rest[:, i], weight + rest[:, end])
            for end, weight, number in self._edges(i, log):
                level = ways[:, i] + weight + rest[:, end]
                if number is not None:
                    add(number, level)
                else:
                    for k in range(i, end):
                        add(np.where(weight > NONE / 2, self.v.byte[self.words[:, k]], -1), level)
        for end, number in self.first:
            add(number, padded[number] + rest[:, end])
        add(np.full(n, self.v.mark), log[self.v.mark] + rest[:, 0])
        return out


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, matrix of bytes) of words of equal length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        same = np.flatnonzero(sizes == size)
        step = max(1, AT_ONCE * 16 // max(16, int(size)))
        for i in range(0, len(same), step):
            which = same[i : i + step]
            yield which, np.frombuffer(b"".join([words[k] for k in which]), np.uint8).reshape(len(which), size)


def word_scores(v: Vocabulary, log: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log probability of each word."""
    out = np.zeros(len(words))
    for which, matrix in _by_length(words):
        out[which] = Lattice(v, matrix).forward(log)[:, -1]
    return out


def _lexicon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket, its distinct words and how often each is in training texts."""
    counts: dict[int, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
    for batch in batches:
        for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            words, seen = blocks.words_of(payload)
            own = counts[bucket]
            for word, c in zip(words, seen.tolist(), strict=True):
                own[word] += c
    for bucket in sorted(counts):
        words, c = list(counts[bucket]), np.array(list(counts[bucket].values()), np.int64)
        payload = blocks.pack(np.array([len(w) for w in words], np.uint32), np.frombuffer(b"".join(words), np.uint8), c)
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([payload], pa.binary()), pa.array([int(c.sum())], pa.int64()),
                                          pa.array([int((c > 0).sum())], pa.int64()), pa.array([int((c == 1).sum())], pa.int64()), pa.array([int((c == 2).sum())], pa.int64())],
                                        names=["bucket", "payload", "total", "distinct", "once", "twice"])


def _expect(v: Vocabulary, log: np.ndarray, given: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(log))
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                words, c = blocks.words_of(payload)
                trained = np.flatnonzero(c)
                for which, matrix in _by_length([words[k] for k in trained]):
                    out += Lattice(v, matrix).expected(log, np.full(len(which), given))
        piece = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(out[piece])], names=["piece", "n"])

    return run


def _answer(v: Vocabulary, log: np.ndarray, given: float, whole: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A bucket's lexicon comes before its blocks' word lists; each of these gets the words' counts and scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for bucket, block, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "payload")), strict=True):
                words, c = blocks.words_of(payload)
                if block is None:
                    if bucket != current:
                        current, known = bucket, {}
                    edge = np.where(c > 0, np.log(np.maximum(c - given, 1e-9) / whole), NONE)
                    known |= zip(words, zip(c.tolist(), np.logaddexp(word_scores(v, log, words), edge).tolist(), strict=True), strict=True)
                else:
                    found = [known[w] for w in words]
                    out[0].append(block)
                    out[1].append(bucket)
                    out[2].append(blocks.pack(np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array([True] * len(out[0]), pa.bool_()),
                                              pa.array(out[2], pa.binary())], schema=blocks.ARROW)

    return run


def _finish(total: int, distinct: int, end_count: int, end_score: float) -> Callable[[blocks.Block, list[bytes]], pa.Table]:
    base = lambda c: np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))

    def run(block: blocks.Block, answers: list[bytes]) -> pa.Table:
        parts = [blocks.unpack(a) for a in answers]
        c = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        s = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        place, n = block.place()[block.words], len(block.n)
        doc = np.repeat(np.arange(n), block.n)
        sums = [np.bincount(doc, w, n) for w in ((c > 0)[place], base(c)[place], s[place])] if len(place) else [np.zeros(n)] * 3
        return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "n_tokens": pa.array(block.n.astype(np.int64) + 1),
                         "n_known": pa.array(sums[0].astype(np.int64) + (end_count > 0)), "train_tokens": pa.array(np.full(n, total, np.int64)),
                         "base_score": pa.array(sums[1] + float(base(end_count))), "score": pa.array((sums[2] + end_score) / np.log(10))})

    return run


def score(docs: DataFrame, training: Column, vocabulary: Vocabulary, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of (doc_id, text)."""
    prepare(docs.sparkSession)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(training, F.lit(True)).alias("training"))
    ends = marked.where("training").count()
    rows = stored(blocks.cut(marked, pretokens.words), "blocks")
    lists = rows.where("words").select("block", "bucket", "payload")
    lexicon = stored(blocks.dealt(lists.select("bucket", "payload")).mapInArrow(_lexicon, "bucket int, payload binary, total long, distinct long, once long, twice long"), "lexicon")
    sums = lexicon.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct", "once", "twice"))).first()
    total, distinct = sums["total"] + ends, sums["distinct"] + (ends > 0)
    given = min(0.9, max(0.1, sums["once"] / max(1, sums["once"] + 2 * sums["twice"])))

    def logs(pieces: np.ndarray) -> tuple[np.ndarray, float]:
        """Logarithms of the pieces' probabilities, and what all counts are divided by."""
        whole = sums["total"] - given * sums["distinct"] + pieces.sum() + PRIOR + ends + 1
        with np.errstate(divide="ignore"):
            return np.maximum(np.log((pieces + PRIOR * vocabulary.prior) / whole), NONE), float(whole)

    log, whole = logs(np.zeros(len(vocabulary.prior)))
    for _ in range(rounds):
        counted = lexicon.select("payload").mapInArrow(_expect(vocabulary, log, given), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        pieces = np.zeros(len(vocabulary.prior))
        for r in counted:
            pieces[r["piece"]] = r["n"]
        log, whole = logs(pieces)
    both = lexicon.select(F.lit(None).cast("long").alias("block"), "bucket", "payload").unionAll(lists)
    answers = blocks.dealt(both).sortWithinPartitions("bucket", F.col("block").asc_nulls_first()).mapInArrow(_answer(vocabulary, log, given, whole), blocks.SCHEMA)
    return blocks.assemble(answers.unionAll(rows.where("not words")), _finish(total, distinct, ends, float(np.log((ends + 1) / whole))),
                           "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
