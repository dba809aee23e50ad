"""Groups of spelling variants: words one insertion, deletion or replacement of a code point apart, found in suffix-rank intervals.

Two words with one error between them share either the first half of the one or its second half. The search scheme therefore has
two searches: match one half exactly from its end of the word, then extend across the other half and spend the one error there.
The vocabulary is written with a delimiter around each word. Its suffix order answers extensions to one side, the order of its
mirror image those to the other side; together they are the two directions of the index. A search never has to turn round, since
both halves begin at a delimiter, so the two directions may lie in different places: the vocabulary is sorted once by word and
once by mirrored word and cut into blocks of a bounded number of words. A query goes to those blocks whose range of words meets
the range of its half, nearly always one; of each pair the second direction only reports what the first can't see.

An interval of suffix ranks stands for all places of a pattern. It is extended by one symbol with two lookups in the sorted list
of (symbol, rank) pairs of the transformed text, for all queries of a batch at once.

Null and empty texts have no words; a null doc_id is written as nothing in the checksum. Repeated rows count as often as they
occur. Ties for the most frequent near word go to the smallest in code-point order. Words may be of any length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import spans, tokens
from bureaulake.llm.blocks import slices, take
from bureaulake.llm.common import partitions, prepare, stored

#: Words of an index block, words of a block that is made only to keep tasks busy, and sampled words for each block's bounds.
BLOCK_WORDS, LEAST_WORDS, SAMPLE = 100_000, 4000, 16
#: Different words a worker counts before it hands them on; queries and rows of intervals looked at in one go.
REMEMBER, QUERIES, ROWS = 300_000, 20_000, 2_000_000

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


# ---- words


def runs_of_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, the text of each and its number of code points."""
    wide = data == 0xC3  # leads exactly the characters from U+00C0 to U+00FF
    inside = LETTER[data] | wide
    inside[1:] |= wide[:-1]
    edge = tokens.edges_of(len(data), offsets)
    padded = np.concatenate([[False], inside, [False]])
    starts = np.flatnonzero(inside & (~padded[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (~padded[2:] | edge[1:])) + 1
    total = np.concatenate([[0], np.cumsum(wide)])
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, ends - starts - (total[ends] - total[starts])


def _count(least: int, every: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, _, data, offsets in tokens.chunks(batch.column("text")):
                data = tokens.LOWER[data]
                starts, ends, owner, size = runs_of_letters(data, offsets)
                long = size >= least
                starts, ends, owner, size = starts[long], ends[long], owner[long], size[long]
                codes, first = spans.distinct(data, starts, ends)
                if not len(codes):
                    continue
                words = spans.values(data, starts[first], ends[first])
                pairs, often = np.unique(owner * len(first) + codes, return_counts=True)
                owner, codes = np.divmod(pairs, len(first))
                seeds = [zlib.crc32(b"%s:" % (b"" if d is None else str(d).encode())) for d in ids[i : i + len(offsets) - 1]]
                h = np.fromiter((zlib.crc32(words[c], seeds[o]) for c, o in zip(codes.tolist(), owner.tolist(), strict=True)), np.int64, len(codes))
                hit = h % every == 0
                for word, n in zip(words, np.bincount(codes[~hit], often[~hit], len(first)).astype(np.int64).tolist(), strict=True):
                    if n:
                        found[word] = found.get(word, 0) + n
                length = size[first]
                for c, k, n in zip(codes[hit].tolist(), (h[hit] % length[codes[hit]]).tolist(), often[hit].tolist(), strict=True):
                    if length[c] > least:
                        text = words[c].decode()
                        word = (text[:k] + text[k + 1 :]).encode()
                        found[word] = found.get(word, 0) + n
                if len(found) >= REMEMBER:
                    yield flush()
        if found:
            yield flush()

    return run


def vocabulary(docs: DataFrame, least: int = 7, often: int = 2, every: int = 31) -> DataFrame:
    """word, n: distinct runs of at least ``least`` code points that occur ``often``, after one code point of a run is deleted
    where ``every`` divides the checksum of its document and itself."""
    prepare(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count(least, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


# ---- index


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order. 0 is the delimiter: a suffix ends at its first one, equal ones follow their places."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    width = 62 // bits
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    for k in range(width):
        symbol = np.where(alive, padded[k : k + n], 0)
        key = (key << bits) | symbol
        alive &= symbol > 0
    order = np.argsort(key, kind="stable")
    own = key[order]
    fresh = np.concatenate([[True], own[1:] != own[:-1]]) | ~alive[order]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = begin
    size = np.diff(np.append(np.flatnonzero(fresh), n))
    open_ = order[np.repeat(size > 1, size)]
    while len(open_):  # suffixes equal so far: the rank of what follows decides
        pair = rank[open_] * n + rank[np.minimum(open_ + width, n - 1)]
        by = np.argsort(pair, kind="stable")
        open_, pair = open_[by], pair[by]
        old = rank[open_]
        at = np.arange(len(open_))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        same = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[open_] = old + same - group
        size = np.diff(np.append(np.flatnonzero(fresh), len(open_)))
        open_ = open_[np.repeat(size > 1, size)]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class Symbols:
    """Words as numbers: 0 is the delimiter, 1 and up the block's code points, the highest one any other code point."""

    def __init__(self, words: list[str]):
        self.alphabet = np.unique(self._points(words)[0])
        self.other = len(self.alphabet) + 1

    @staticmethod
    def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words one after the other, and the words' lengths."""
        points, size = self._points(words)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, self.other), size


class Index:
    """Suffix ranks of a delimited vocabulary that extend a pattern to the right: the order is that of the mirrored text."""

    def __init__(self, words: list[str]):
        self.words, self.symbols = words, Symbols(words)
        flat, size = self.symbols.encode(words)
        begin = np.concatenate([[0], np.cumsum(size + 1)]) + 1  # of each mirrored word; a delimiter before and after it
        text = np.zeros(begin[-1], np.int64)
        inner = np.ones(len(text), bool)
        inner[begin - 1] = False
        text[inner] = slices(flat[::-1], len(flat) - np.cumsum(size), size)
        order = suffix_order(text)
        before = text[order - 1]
        self.n = len(text)
        rows = np.argsort(before, kind="stable")
        self.pairs = before[rows] * self.n + rows
        self.before = before
        #: Ranks at which a whole word ends, and the words.
        self.whole = np.flatnonzero(before == 0)
        self.word = np.searchsorted(begin, order[self.whole], "right") - 1
        self.delimiters = int((text == 0).sum())

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol * self.n
        return np.searchsorted(self.pairs, base + low), np.searchsorted(self.pairs, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol): the symbols that follow the patterns of some intervals, delimiters not counted."""
        count = len(self.symbols.alphabet)
        wide = high - low > 4 * count
        parts = []
        if wide.any():
            at = np.flatnonzero(wide)
            at, symbol = np.repeat(at, count), np.tile(np.arange(1, count + 1), len(at))
            a, b = self.extend(symbol, low[at], high[at])
            parts.append((at * (count + 1) + symbol)[b > a])
        narrow = np.flatnonzero(~wide)
        size = high[narrow] - low[narrow]
        symbol = self.before[slices(np.arange(self.n), low[narrow], size)]
        parts.append(np.unique((np.repeat(narrow, size) * (count + 1) + symbol)[symbol > 0]))
        return np.divmod(np.concatenate(parts), count + 1)

    def near(self, words: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word of the index): all pairs with one error behind the first ``halves`` code points, which match exactly."""
        pattern, size = self.symbols.encode(words)
        at = np.cumsum(size) - size
        pattern = np.append(pattern, [0, 0])
        query = np.arange(len(words))
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.delimiters, np.int64)
        for t in range(int(halves.max(initial=0))):
            live = np.flatnonzero(halves[query] > t)
            low[live], high[live] = self.extend(pattern[at[query[live]] + t], low[live], high[live])
            some = high > low
            query, low, high = query[some], low[some], high[some]
        spent: list[tuple[np.ndarray, ...]] = []  # query, interval and next place of the pattern, the error being made
        place = halves[query].copy()
        while len(query):
            left = place < size[query]
            symbol = np.where(left, pattern[at[query] + place], 0)
            after = pattern[at[query] + place + 1]
            drop = left & ((place + 1 == size[query]) | (after != symbol))  # of equal neighbours the last one is left out
            spent.append((query[drop], low[drop], high[drop], place[drop] + 1))
            nodes, node = np.unique(low * (self.n + 1) + high, return_inverse=True)
            a, b = np.divmod(nodes, self.n + 1)
            owner, child = self.children(a, b)
            by = np.argsort(owner, kind="stable")
            owner, child = owner[by], child[by]
            first = np.searchsorted(owner, np.arange(len(nodes) + 1))
            c, d = self.extend(child, a[owner], b[owner])
            many = np.diff(first)[node]
            for i, j in _portions(many):
                q = np.repeat(np.arange(i, j), many[i:j])
                which = take(np.arange(len(owner)), first, node[i:j])
                other = child[which] != symbol[q]
                more, which = q[other], which[other]
                states = query[more], c[which], d[which]
                spent.append((*states, place[more]))  # a symbol too many
                swap = left[more]
                spent.append((*(x[swap] for x in states), place[more][swap] + 1))  # another symbol
                spent = [self._rest(spent, pattern, at, size)]
            low, high = self.extend(symbol, low, high)
            go = left & (high > low)
            query, low, high, place = query[go], low[go], high[go], place[go] + 1
        query, low, high, _ = self._rest(spent, pattern, at, size) if spent else (np.zeros(0, np.int64),) * 4
        where = np.searchsorted(self.whole, low)
        hit = where < len(self.whole)
        hit[hit] &= self.whole[where[hit]] < high[hit]
        return query[hit], self.word[where[hit]]

    def _rest(self, states: list[tuple[np.ndarray, ...]], pattern: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Extends states by the rest of their patterns; those that end in a word stay, at the end of the pattern."""
        query, low, high, place = (np.concatenate(x) for x in zip(*states, strict=True))
        done: list[tuple[np.ndarray, ...]] = []
        while len(query):
            at_end = place >= size[query]
            done.append((query[at_end], low[at_end], high[at_end], place[at_end]))
            query, low, high, place = (x[~at_end] for x in (query, low, high, place))
            low, high = self.extend(pattern[at[query] + place], low, high)
            some = high > low
            query, low, high, place = query[some], low[some], high[some], place[some] + 1
        return tuple(np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 4


def _portions(many: np.ndarray) -> Iterator[tuple[int, int]]:
    total, i = np.concatenate([[0], np.cumsum(many)]), 0
    while i < len(many):
        j = max(i + 1, int(np.searchsorted(total, total[i] + ROWS, "right")) - 1)
        yield i, j
        i = j


# ---- distribution


def _route(bounds: list[list[bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each word to its block of either direction, and as a query to further blocks that its half may meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [0, len(bounds[0]) + 1]
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for side, text in enumerate((word, word[::-1])):
                    key, half = text.encode(), text[: _half(len(text), side)].encode()
                    own = bisect_right(bounds[side], key)
                    for block in range(bisect_right(bounds[side], half), bisect_right(bounds[side], half + b"\xff") + 1):
                        for column, value in zip(out, (first[side] + block, block != own, key, n), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.bool_(), pa.binary(), pa.int64()), strict=True)],
                                             names=["block", "query", "key", "n"])

    return run


def _half(size: int, side: int) -> int:
    """Code points of the half that is matched exactly, counted from this direction's end of the word."""
    return size // 2 if side == 0 else size - size // 2


def _search(second: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Near words of all queries of the blocks. Rows are sorted by block, a block's own words first; blocks from ``second`` on are mirrored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, often = None, [], []
        index: Index | None = None

        def answers(asked: list[str]) -> Iterator[pa.RecordBatch]:
            side = int(block >= second)
            for i in range(0, len(asked), QUERIES):
                some = asked[i : i + QUERIES]
                q, w = index.near(some, np.array([_half(len(x), side) for x in some], np.int64))
                pairs = zip(q.tolist(), w.tolist(), strict=True)
                if side:  # pairs that share the first half are the other direction's
                    found = [(some[a][::-1], index.words[b][::-1], often[b]) for a, b in pairs
                             if index.words[b][::-1][: len(some[a]) // 2] != some[a][::-1][: len(some[a]) // 2]]
                else:
                    found = [(some[a], index.words[b], often[b]) for a, b in pairs]
                word, near, n = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal index
            if index is None and words:
                index = Index(words)
                yield from answers(words)

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if blocks[a] != block:
                    yield from close()
                    block, words, often, index = blocks[a], [], [], None
                part = batch.slice(a, b - a)
                asks = part.column("query").to_numpy(zero_copy_only=False)
                texts = [x.decode() for x in part.column("key").to_pylist()]
                own = len(texts) - int(asks.sum())
                words += texts[:own]
                often += part.column("n").to_pylist()[:own]
                if own < len(texts):
                    yield from close()
                    if index is not None:
                        yield from answers(texts[own:])
        yield from close()

    return run


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, near, near_n: all ordered pairs of the distinct words of (word, n) with exactly one error between them, each once.

    The blocks' bounds come from a sample drawn by hash, about ``SAMPLE`` words for each block of ``block_words``: the driver sees
    one word in six thousand. All words are indexed and all are queries.
    """
    spark = prepare(words.sparkSession)
    count = words.count()
    blocks = max(-(-count // block_words), min(partitions(spark), count // LEAST_WORDS), 1)
    rate = max(1, count // (blocks * SAMPLE))
    drawn = [r["word"] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).select("word").collect()] if blocks > 1 else []
    bounds = []
    for texts in (drawn, [w[::-1] for w in drawn]):
        keys = sorted(w.encode() for w in texts)
        bounds.append(sorted({keys[len(keys) * k // blocks] for k in range(1, blocks)}) if keys else [])
    routed = words.select("word", "n").mapInArrow(_route(bounds), "block int, query boolean, key binary, n long")
    dealt = routed.repartition("block").sortWithinPartitions("block", "query")
    return dealt.mapInArrow(_search(len(bounds[0]) + 1), "word string, near string, near_n long")


def variants(words: DataFrame, factor: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of (word, n); words are distinct.

    A form is at least ``factor`` times as frequent as its word, so paths to a root are no longer than the digits of the largest
    count in base ``factor``, and pointers that double their reach need the logarithm of that many rounds.
    """
    words = stored(words.select("word", "n"), "words")
    near = near_words(words, block_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    best = (-F.col("best.less")) >= factor * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best, F.col("best.form")).alias("form"), F.when(best, -F.col("best.less")).alias("form_n")), "forms")
    links = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    largest = table.agg(F.max("n").alias("n")).first()["n"] or 1
    hops = 0
    while largest >= factor:
        largest, hops = largest // factor, hops + 1
    for _ in range(max(0, hops - 1).bit_length()):
        step = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return table.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
