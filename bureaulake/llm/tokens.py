"""Whole texts cut into words with numpy, over the bytes of an Arrow column.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. No word becomes a
Python object here: spans and 64-bit hashes of spans stand for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes handled at once; a longer single text is handled alone.
CHUNK = 2 << 20
#: Longer spans are hashed one by one.
LONG_SPAN = 64

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(max(n, CHUNK + 1), base, np.uint64)
            grown[0] = 1
            _powers[i] = np.multiply.accumulate(grown)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(ends) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK,
           rows: int = 1 << 31) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of at most ``rows`` texts and ``limit`` bytes, or one longer text."""
    data, offsets = text_bytes(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1), i + rows)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def edges_of(n: int, offsets: np.ndarray) -> np.ndarray:
    """True where a text begins."""
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    return edge


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text where its words begin (n + 1 numbers)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    blank, edge = BLANK[data], edges_of(n, offsets)
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = blank[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = blank[1:]
    starts = np.flatnonzero(~blank & (before | edge[:-1]))
    ends = np.flatnonzero(~blank & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: equal bytes, equal hash, wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=total[1:])
    size = (ends - starts).astype(np.uint64)
    h = mix((total[ends] - total[starts]) * down[starts] + size * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(ends - starts > LONG_SPAN):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return h


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags in each text; ``flags`` has one entry per byte or word, ``offsets`` counts the same things."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each thing, the text it is in."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words that lies within one text, and the place of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = owners(offsets)
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = h * np.uint64(0xD1342543DE82EF95) + hashes[at + k]
    return mix(h), at
