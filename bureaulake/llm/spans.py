"""Byte spans told apart exactly: hashes propose which are equal, their bytes decide."""

from __future__ import annotations

import numpy as np
import pandas as pd

from bureaulake.llm import tokens
from bureaulake.llm.blocks import slices


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each span the number of its value, and for each value the span where it stands first, in the order of these."""
    hashes = tokens.span_hashes(data, starts, ends) if hashes is None else hashes
    codes, _ = pd.factorize(hashes)
    if not len(codes):
        return codes, codes
    first = np.flatnonzero(codes > np.maximum.accumulate(np.append(-1, codes[:-1])))
    size, model = ends - starts, first[codes]
    if (size == size[model]).all() and (slices(data, starts, size) == slices(data, starts[model], size)).all():
        return codes, first
    text, known = data.tobytes(), {}  # two values with one hash
    codes = np.array([known.setdefault(text[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
    return codes, np.flatnonzero(codes > np.maximum.accumulate(np.append(-1, codes[:-1])))


def values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of each span."""
    text = data.tobytes()
    return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
