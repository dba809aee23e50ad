"""Texts cut into pre-tokens with numpy, as the usual byte-level pattern does:

``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``

Every byte is in exactly one pre-token. Characters count as letters, numbers or white space by Unicode.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

from bureaulake.llm import tokens

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Unicode's White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def kinds() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    code = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, everything):
            table[code[m.start() : m.end()]] = kind
    table[WHITE] = SPACE
    return table


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, where each text's pre-tokens begin)."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return data, none, none, np.zeros(len(offsets), np.int64)
    char_at = np.flatnonzero((data & 0xC0) != 0x80)
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(text)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(char_at, offsets)] = True
    kind = kinds()[text]
    start = np.ones(n + 1, bool)
    start[1:-1] = kind[1:] != kind[:-1]
    start |= edge
    run = start.copy()
    # white space before something else: the last one stands apart, or goes with it if it is a blank
    after = np.flatnonzero(run[:-1] & (kind != SPACE) & ~edge[:-1])
    after = after[after > 0]
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    start[after[text[after - 1] == 32]] = False
    # contractions, where a pre-token begins with the apostrophe
    marks = np.flatnonzero((text == 39) & run[:-1])
    marks = marks[start[marks]]
    padded = np.append(text, [0, 0])
    one, two = padded[marks + 1], padded[marks + 2]
    inside, further = ~edge[marks + 1], ~edge[np.minimum(marks + 2, n)] & ~edge[marks + 1]
    size = np.where(inside & np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
    for pair in ("re", "ve", "ll"):
        size = np.where(further & (one == ord(pair[0])) & (two == ord(pair[1])), 3, size)
    marks, size = marks[size > 0], size[size > 0]
    start[marks + 1] = False
    start[marks + size] = True
    start[n] = False
    begins = np.flatnonzero(start[:n])
    starts = char_at[begins]
    return data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, with A-Z as a-z; a cutter for blocks."""
    data = tokens.LOWER[data]
    return data, *tokens.word_spans(data, offsets)
