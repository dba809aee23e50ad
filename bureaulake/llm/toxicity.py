"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

Inputs of each word are its word embedding (words of several training texts have one of their own, all others share one) and the
mean embedding of its hashed character n-grams. Windows of
consecutive words overlap and cover the whole text; a text's score is that of its worst window. Letters A-Z count as a-z.
Null, empty and wordless texts are scored as one window without words. Without labels of both kinds the score is the share
of toxic labels (0 without any). Repeated rows give repeated results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import tokens
from bureaulake.llm.common import prepare, rows_where

CHAR_ROWS, WIDTH, HIDDEN = 1 << 15, 8, 8
#: Training texts that a word must be in to have an embedding of its own; fewer if there are few toxic ones.
WORD_TEXTS = 20
#: Words of a window, and from one window's begin to the next.
WINDOW, STRIDE = 32, 24
#: Toxic texts that the network is trained on, of others twice as many; all windows of each, whatever its length.
SAMPLE = 1200
#: Bytes of the longest text that may be drawn, where a task's memory asks for a bound; by default there is none.
LONGEST: int | None = None
THRESHOLD = 0.3
GRAMS = (3, 4, 5)
#: Spellings whose n-grams are held at once.
AT_ONCE = 1 << 14
TABLES = ("word", "char")
#: Part of the embeddings that fades with each step, by the learning rate.
DECAY = 0.2


# ---- words and their inputs


def spell(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of character n-grams of each word, begin and end marked, as (rows, offsets per word)."""
    parts = [_spell(data, starts[i : i + AT_ONCE], ends[i : i + AT_ONCE]) for i in range(0, max(1, len(starts)), AT_ONCE)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])


def _spell(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = ends - starts
    padded_at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size + 2, out=padded_at[1:])
    text = np.zeros(padded_at[-1], np.uint8)
    owner = np.repeat(np.arange(len(starts)), size)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    text[padded_at[owner] + 1 + inner] = data[starts[owner] + inner]
    rows, places = [], []
    word = np.repeat(np.arange(len(starts)), size + 2)
    for n in GRAMS:
        if len(text) < n:
            continue
        at = np.flatnonzero(word[: len(text) - n + 1] == word[n - 1 :])
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + text[at + k] + np.uint64(1)
        rows.append((tokens.mix(h) % np.uint64(CHAR_ROWS)).astype(np.int32))
        places.append(word[at])
    if not rows:
        return np.zeros(0, np.int32), np.zeros(len(starts) + 1, np.int64)
    rows, places = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(places, kind="stable")
    return rows[order], np.searchsorted(places[order], np.arange(len(starts) + 1))


def mean_rows(table: np.ndarray, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = np.diff(offsets)
    out = np.zeros((len(n), table.shape[1]), np.float32)
    for i in range(0, len(n), AT_ONCE):
        own, some = n[i : i + AT_ONCE], offsets[i : i + AT_ONCE + 1]
        full = own > 0
        if full.any():
            sums = np.add.reduceat(table[rows[some[0] : some[-1]]], some[:-1][full] - some[0], axis=0)
            out[i : i + AT_ONCE][full] = sums / own[full, None]
    return out


def window_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word within it) of each window; one window for a text without words."""
    n = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), n)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


class Words:
    """The words of some texts: distinct spellings, and for each word which one it is; 0 stands for no word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = tokens.LOWER[data]
        starts, ends, self.first = tokens.word_spans(data, offsets)
        hashes = tokens.span_hashes(data, starts, ends)
        self.keys, at, self.spelling = np.unique(hashes, return_index=True, return_inverse=True)
        self.spelling = self.spelling.astype(np.int32) + 1
        self.grams, self.gram_offsets = spell(data, starts[at], ends[at])
        self.text, self.begin = window_starts(np.diff(self.first))

    def windows(self, pick: np.ndarray) -> np.ndarray:
        """Spellings of the picked windows' words, windows x WINDOW."""
        at = self.first[self.text[pick]][:, None] + self.begin[pick][:, None] + np.arange(WINDOW)
        inside = at < self.first[self.text[pick] + 1][:, None]
        padded = np.append(self.spelling, 0)
        return np.where(inside, padded[np.minimum(at, len(padded) - 1)], 0)


# ---- the network


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(vocabulary: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    d, h = 2 * WIDTH, HIDDEN
    p = {"vocabulary": vocabulary, "word": normal(len(vocabulary) + 1, WIDTH, s=0.05), "char": normal(CHAR_ROWS, WIDTH, s=0.05)}
    for side in "fb":
        p |= {f"W{side}": normal(d, 3 * h, s=d**-0.5), f"U{side}": normal(h, 3 * h, s=h**-0.5), f"c{side}": np.zeros(3 * h, np.float32)}
    return p | {"attend": normal(2 * h, s=0.3), "out": normal(2 * h, s=0.3), "bias": np.zeros(1, np.float32)}


def word_rows(p: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Row of the word table for each spelling's key; 0 for words outside the vocabulary."""
    v = p["vocabulary"]
    if len(v) == 0:
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(v, keys), len(v) - 1)
    return np.where(v[at] == keys, at + 1, 0)


def summed_rows(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values that go to each of n rows."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        out[rows[begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


def inputs(p: dict[str, np.ndarray], words: Words) -> np.ndarray:
    """Input of each spelling; row 0 is zero and stands for no word."""
    x = np.concatenate([p["word"][word_rows(p, words.keys)], mean_rows(p["char"], words.grams, words.gram_offsets)], axis=1)
    return np.concatenate([np.zeros((1, x.shape[1]), np.float32), x])


def recur(gates: np.ndarray, U: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states of a gated recurrent layer from its input gates, both time x windows x units."""
    h = HIDDEN
    state = np.zeros((gates.shape[1], h), np.float32)
    out = np.empty((*gates.shape[:2], h), np.float32)
    for t in range(len(gates)):
        own = state @ U
        zr = sigmoid(gates[t, :, : 2 * h] + own[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        new = np.tanh(gates[t, :, 2 * h :] + r * own[:, 2 * h :])
        if keep is not None:
            keep.append((state, z, r, new, own[:, 2 * h :]))
        state = state + z * (new - state)
        out[t] = state
    return out


def recur_back(grad: np.ndarray, kept: list, U: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = HIDDEN
    d_gates = np.empty((*grad.shape[:2], 3 * h), np.float32)
    d_U, carry = np.zeros_like(U), np.zeros_like(grad[0])
    for t in range(len(grad) - 1, -1, -1):
        state, z, r, new, own = kept[t]
        d = grad[t] + carry
        d_new = d * z * (1 - new * new)
        d_z = d * (new - state) * z * (1 - z)
        d_r = d_new * own * r * (1 - r)
        d_gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_own = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_U += state.T @ d_own
        carry = d * (1 - z) + d_own @ U.T
    return d_gates, d_U


def forward(p: dict[str, np.ndarray], x: np.ndarray, spelled: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logit of each window. spelled: windows x WINDOW, rows of x."""
    time = spelled.T
    states = []
    for side, order in (("f", time), ("b", time[::-1])):
        gates = (x @ p[f"W{side}"] + p[f"c{side}"])[order]
        kept: list | None = None if keep is None else []
        s = recur(gates, p[f"U{side}"], kept)
        states.append(s if side == "f" else s[::-1])
        if keep is not None:
            keep[side] = kept
    both = np.concatenate(states, axis=2)
    level = np.where(time > 0, both @ p["attend"], -30.0).astype(np.float32)
    share = np.exp(level - level.max(0))
    share /= share.sum(0)
    pooled = np.einsum("tb,tbh->bh", share, both)
    if keep is not None:
        keep |= {"both": both, "share": share, "pooled": pooled}
    return pooled @ p["out"] + p["bias"][0]


def backward(p: dict[str, np.ndarray], words: Words, x: np.ndarray, spelled: np.ndarray, keep: dict, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    both, share, pooled = keep["both"], keep["share"], keep["pooled"]
    g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    d_share = np.einsum("tbh,bh->tb", both, d_pooled)
    d_level = share * (d_share - (share * d_share).sum(0))
    g["attend"] = np.einsum("tb,tbh->h", d_level, both)
    d_both = share[:, :, None] * d_pooled + d_level[:, :, None] * p["attend"]
    d_x = np.zeros_like(x)
    time = spelled.T
    for side, order, d in (("f", time, d_both[:, :, :HIDDEN]), ("b", time[::-1], d_both[::-1, :, HIDDEN:])):
        d_gates, g[f"U{side}"] = recur_back(d, keep[side], p[f"U{side}"])
        flat, rows = d_gates.reshape(-1, d_gates.shape[2]), order.reshape(-1)
        summed = summed_rows(flat, rows, len(x))
        g[f"W{side}"], g[f"c{side}"] = x.T @ summed, flat.sum(0)
        d_x += summed @ p[f"W{side}"].T
    g["word"] = summed_rows(d_x[1:, :WIDTH], word_rows(p, words.keys), len(p["word"]))
    n = np.diff(words.gram_offsets)
    g["char"] = summed_rows(np.repeat(d_x[1:, WIDTH:] / np.maximum(n, 1)[:, None], n, axis=0), words.grams, len(p["char"]))
    return g


def train(texts: list[str | None], toxic: np.ndarray, share: float = 0.1, epochs: int = 4, steps: int = 300, batch: int = 256, rate: float = 0.01, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam on windows, for at least so many epochs and steps. In the first quarter every window of a toxic text counts as toxic, later its worst one alone.

    An embedding table has one second moment for all its rows: with one for each, n-grams seen once would learn as fast as
    those seen often. In the end the scale of the texts' worst windows, of all they have, is fitted to their labels, at the ``share`` of toxic texts.
    """
    rng = np.random.default_rng(seed)
    data, offsets = tokens.text_bytes(pa.array(texts, pa.string()))
    words = Words(data, offsets)
    seen = np.unique(tokens.owners(words.first) * np.int64(len(words.keys) + 1) + words.spelling)
    often = np.bincount(seen % (len(words.keys) + 1), minlength=len(words.keys) + 1)[1:] >= min(WORD_TEXTS, 2 + toxic.sum() // 10)
    p = initial(words.keys[often])
    label = toxic[words.text].astype(np.float32)
    spelled = np.concatenate([words.windows(np.arange(k, min(k + 8192, len(words.text)))).astype(np.int32) for k in range(0, len(words.text), 8192)])
    m = {k: np.zeros_like(v) for k, v in p.items() if k != "vocabulary"}
    s = {k: np.zeros(1, np.float32) if k in TABLES else np.zeros_like(v) for k, v in m.items()}
    epochs = max(epochs, -(-steps * batch // max(1, len(label))))
    step = 0
    for epoch in range(epochs):
        use = np.arange(len(label))
        if 4 * epoch >= epochs:
            logits = score_windows(p, inputs(p, words), spelled)
            order = np.lexsort((logits, words.text))
            last = np.append(words.text[order][1:] != words.text[order][:-1], True)
            worst = np.zeros(len(label), bool)
            worst[order[last]] = True
            clean = label == 0  # of clean windows the half that looks more toxic
            clean &= logits >= np.median(logits[clean])
            use = np.flatnonzero(clean | (worst & (label == 1)))
        part = max(label[use].mean(), 1e-3)  # of the windows in use, not of the texts
        weigh = np.where(label == 1, 0.5 / part, 0.5 / (1 - part)).astype(np.float32)
        rng.shuffle(use)
        for i in range(0, len(use), batch):
            pick = use[i : i + batch]
            local, rows = np.unique(spelled[pick], return_inverse=True)
            some = _subset(words, local)
            x, keep, at = inputs(p, some), {}, rows.reshape(spelled[pick].shape) + (local[0] != 0)
            logit = forward(p, x, at, keep)
            d = (sigmoid(logit) - label[pick]) * weigh[pick] / len(pick)
            step += 1
            lr = rate * min(1.0, step / 20) * 0.5 ** max(0, 4 * epoch // epochs - 1)
            for k, g in backward(p, some, x, at, keep, d.astype(np.float32)).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * ((g * g).sum() / max(1, np.count_nonzero(g)) if k in TABLES else g * g)
                if k in TABLES:
                    p[k] *= 1 - 5 * lr * DECAY
                p[k] = p[k] - (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    p["scale"] = scale(worst_windows(p, words, len(texts)), toxic, share)
    return p


def worst_windows(p: dict[str, np.ndarray], words: Words, n: int) -> np.ndarray:
    """The largest logit of all windows of each of n texts."""
    x = inputs(p, words)
    worst = np.full(n, -np.inf)
    for k in range(0, len(words.text), 8192):
        pick = np.arange(k, min(k + 8192, len(words.text)))
        np.maximum.at(worst, words.text[pick], score_windows(p, x, words.windows(pick)))
    return worst


def scale(worst: np.ndarray, toxic: np.ndarray, share: float, rounds: int = 200) -> np.ndarray:
    """Slope and shift of the worst windows' logits, by regularised logistic regression; the slope isn't negative."""
    a, b = 1.0, 0.0
    weight = np.where(toxic == 1, share / max(toxic.mean(), 1e-6), (1 - share) / max(1 - toxic.mean(), 1e-6))
    for _ in range(rounds):
        q = sigmoid(a * worst + b)
        d, h = (q - toxic) * weight, q * (1 - q) * weight + 1e-3
        g = np.array([(d * worst).mean() + 1e-3 * (a - 1), d.mean()])
        H = np.array([[(h * worst * worst).mean() + 1e-3, (h * worst).mean()], [(h * worst).mean(), h.mean()]])
        move = np.clip(np.linalg.solve(H, g), -0.5, 0.5)
        a, b = max(0.1, a - move[0]), b - move[1]
    return np.array([a, b])


def _subset(words: Words, spelled: np.ndarray) -> Words:
    """The given spellings alone, without 0."""
    some = spelled[spelled > 0] - 1
    part = object.__new__(Words)
    part.keys = words.keys[some]
    n = np.diff(words.gram_offsets)[some]
    part.gram_offsets = np.concatenate([[0], np.cumsum(n)])
    part.grams = words.grams[np.repeat(words.gram_offsets[some] - part.gram_offsets[:-1], n) + np.arange(part.gram_offsets[-1])]
    return part


def score_windows(p: dict[str, np.ndarray], x: np.ndarray, spelled: np.ndarray, batch: int = 4096) -> np.ndarray:
    parts = [forward(p, x, spelled[i : i + batch]) for i in range(0, len(spelled), batch)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


# ---- on Spark


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> tuple[dict[str, np.ndarray] | None, float]:
    """The network, and the share of toxic labels; trained on at most ``sample`` toxic and twice as many other whole texts,
    drawn by a hash of the id."""
    prepare(docs.sparkSession)
    marks = labels.select(F.col("doc_id").alias("doc_id"), "toxic").where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marks.where(training).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return None, share
    draw = F.xxhash64("doc_id", F.lit("toxicity"))
    short = F.lit(True) if LONGEST is None else F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST
    # the draw is made on ids alone, of texts that can be used, so that only the drawn texts are gathered
    usable = marks.where(training).join(docs.where(short).select("doc_id"), "doc_id", "left_semi")
    drawn = usable.where("toxic = 1").orderBy(draw, "doc_id").limit(sample).unionAll(usable.where("toxic = 0").orderBy(draw, "doc_id").limit(2 * sample))
    ids = {r["doc_id"]: r["toxic"] for r in drawn.collect()}
    rows = docs.where(F.col("doc_id").isin(list(ids)) & short).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = sorted(((i, t or "") for batch in batches for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)))
        toxic = np.array([ids[i] for i, _ in some], int)
        if 0 < toxic.sum() < len(toxic):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([t for _, t in some], toxic, share))], pa.binary())], names=["model"])

    # the sample is bounded, so one task can hold it; the driver gets the finished weights alone
    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return (pickle.loads(bytes(found[0]["model"])) if found else None), share


def grade(p: dict[str, np.ndarray], texts: pa.Array) -> np.ndarray:
    """Score of each text, by its worst window."""
    scores = [np.zeros(0)]
    for i, j, data, offsets in tokens.chunks(texts):
        worst = worst_windows(p, Words(data, offsets), j - i)
        scores.append(sigmoid(p["scale"][0] * worst + p["scale"][1]))
    return np.concatenate(scores)


def _score(p: dict[str, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(grade(p, batch.column("text")), pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: dict[str, np.ndarray] | None, share: float = 0.0, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        scored = rows.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        prepare(docs.sparkSession)
        scored = rows.mapInArrow(_score(model), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, model: dict[str, np.ndarray] | None, share: float = 0.0, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that aren't predicted toxic, with all their columns. Without a model nothing is known against any row, so all stay."""
    if model is None:
        return docs
    prepare(docs.sparkSession)
    return rows_where(docs, lambda texts: grade(model, texts) < threshold)
