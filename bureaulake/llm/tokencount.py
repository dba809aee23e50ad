"""Token counts of whole texts by a byte-level BPE vocabulary, without encoding the texts.

Before any text is read, each string of the vocabulary is put through the merges alone. Those that come out as one token are
proven whole: a pre-token equal to one counts as 1 by a lookup. Only the other pre-tokens are merged, each distinct one once
per batch or less: a worker remembers a bounded number of them.

The library's default is kept: strings of added tokens inside a text are one token each, and the text is cut there first. Null
texts count as empty, with 0 bytes and 0 tokens. Repeated rows, null ids and ties stay as they are; other columns are not read.
A text longer than a chunk is cut only where a blank follows a visible ASCII character, where every pre-token ends.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from bureaulake.llm import pretokens, spans, tokens
from bureaulake.llm.common import prepare

#: Distinct pre-tokens a worker remembers before it starts anew.
REMEMBER = 400_000
ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("n_whole", pa.int64())])
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long"


@cache
def spelling() -> dict[int, str]:
    """How the vocabulary file spells bytes: visible Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def spelled(word: bytes) -> str:
    return word.decode("latin-1").translate(spelling())


@cache
def load(path: str) -> tuple[models.BPE, frozenset[bytes], re.Pattern[bytes] | None]:
    """The merges, the strings proven whole, and a pattern of the added tokens; worked out once per worker from the file alone."""
    model = Tokenizer.from_file(path).model
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    cut = (described["pre_tokenizer"] or {}) | {"normalizer": described["normalizer"]}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or cut["normalizer"]:
        raise ValueError(f"{path} does not cut texts by the byte-level pattern alone")
    added = described["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take in their surroundings")
    back = {c: b for b, c in spelling().items()}
    names = {t["content"] for t in added}
    whole = frozenset(bytes(back[c] for c in s) for s in described["model"]["vocab"] if s not in names and len(model.tokenize(s)) == 1)
    found = sorted((t["content"].encode() for t in added), key=len, reverse=True)
    return model, whole, re.compile(b"|".join(map(re.escape, found))) if found else None


def _sections(data: np.ndarray, offsets: np.ndarray, added: re.Pattern[bytes] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of sections, the text of each, whether it is an added token): texts cut at added tokens, long ones also at blanks."""
    cuts, special = [offsets], np.zeros(0, np.int64)
    if added is not None:
        text, bounds, taken = data.tobytes(), offsets.tolist(), []
        if added.search(text):
            for a, b in zip(bounds, bounds[1:]):
                taken += [m.span() for m in added.finditer(text, a, b)]
        if taken:
            special, after = np.array(taken, np.int64).T
            cuts += [special, after]
    if len(data) > tokens.CHUNK and len(offsets) == 2:
        blanks = np.flatnonzero((data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)) + 1
        wanted = np.searchsorted(blanks, np.arange(tokens.CHUNK, len(data), tokens.CHUNK))
        blanks = blanks[wanted[wanted < len(blanks)]]
        if len(special):  # not inside an added token
            k = np.searchsorted(special, blanks, "right") - 1
            blanks = blanks[(k < 0) | (blanks >= after[k])]
        cuts.append(blanks)
    at = np.unique(np.concatenate(cuts))
    owner = np.searchsorted(offsets, at[:-1], "right") - 1
    return at, owner, np.isin(at[:-1], special)


def _counts(column: pa.Array, path: str, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, tokens and directly counted tokens of each text."""
    model, whole, added = load(path)
    n_bytes, n_tokens, n_whole = (np.zeros(len(column), np.int64) for _ in range(3))
    for i, j, data, offsets in tokens.chunks(column):
        n_bytes[i:j] = np.diff(offsets)
        at, owner, special = _sections(data, offsets, added)
        np.add.at(n_tokens, i + owner[special], 1)
        a = 0
        while a < len(owner):
            b = max(a + 1, int(np.searchsorted(at, at[a] + tokens.CHUNK, "right")) - 1)
            part, starts, ends, first = pretokens.pretokens(data[at[a] : at[b]], at[a : b + 1] - at[a])
            codes, places = spans.distinct(part, starts, ends)
            if len(known) > REMEMBER:
                known.clear()
            size, direct = np.ones(len(places), np.int64), np.ones(len(places), bool)
            for k, word in enumerate(spans.values(part, starts[places], ends[places])):
                if word not in whole:
                    n = known.get(word)
                    if n is None:
                        n = known[word] = len(model.tokenize(spelled(word)))
                    size[k], direct[k] = n, False
            plain = ~special[a:b]
            np.add.at(n_tokens, i + owner[a:b][plain], tokens.per_text(size[codes], first)[plain])
            np.add.at(n_whole, i + owner[a:b][plain], tokens.per_text(direct[codes], first)[plain])
            a = b
    return n_bytes, n_tokens, n_whole


def count(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``) and n_whole (counted directly) of each row of (doc_id, text)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            n_bytes, n_tokens, n_whole = _counts(batch.column("text"), path, known)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_bytes, n_tokens, n_tokens > limit, n_whole))], schema=ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
