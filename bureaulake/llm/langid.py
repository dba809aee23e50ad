"""Language by nearest centroid: normalised TF-IDF vectors of byte trigrams against several centroids per language, by cosine.

A text with no letter, or null, is ``und`` with score 0. Any other text gets the language of its nearest centroid; ``rejected``
says that it is farther from that centroid than texts of its length are, so it is likely in none of the learned languages.
Without any labelled text everything is ``und``. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.llm import tokens
from bureaulake.llm.common import prepare, rows_where

#: Hashed trigrams.
BINS = 4096
#: Texts handled as one matrix.
ROWS = 512
#: Labelled texts per language that the centroids are fitted on, and that are seen as a whole and as two short cuts.
SAMPLE = 250
CUTS = (30, 200)
TEMPERATURE = 0.05
#: Part of the least cosine of the sample's own texts below which a text is rejected.
SLACK = 0.5

_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, anything but letters as space, with a space before and after each text."""
    text = _PLAIN[data]
    second = np.zeros(len(text), bool)
    second[1:] = (text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] <= 0x9E) & (text[1:] != 0x97)
    text = text + (second * np.uint8(32))
    padded = np.full(len(text) + 2 * (len(offsets) - 1), 32, np.uint8)
    padded[np.arange(len(text)) + 2 * tokens.owners(offsets) + 1] = text
    return padded, offsets + 2 * np.arange(len(offsets))


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x BINS trigram counts; runs of spaces give none."""
    text, ends = plain(data, offsets)
    n = len(ends) - 1
    if len(text) < 3:
        return np.zeros((n, BINS), np.float32)
    code = text.astype(np.uint32)
    code = code[:-2] * np.uint32(65536) + code[1:-1] * np.uint32(256) + code[2:]
    blank = text == 32
    keep = ~(blank[1:-1] & (blank[:-2] | blank[2:]))
    at = np.flatnonzero(keep)
    code = ((code[at] * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    owner = np.searchsorted(ends, at, "right") - 1
    return np.bincount(owner * BINS + code, minlength=n * BINS).reshape(n, BINS).astype(np.float32)


def lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
    found = tokens.per_text(ascii_letter, offsets) > 0
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(BINS, np.int64), 0
    for batch in batches:
        for i, j, data, offsets in tokens.chunks(batch.column("text"), rows=ROWS):
            total += (counts(data, offsets) > 0).sum(0)
            n += j - i
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BINS)), pa.array(np.concatenate([[n], total]))], names=["bin", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, out = batch.column("lang").to_pylist(), []
        for i, j, data, offsets in tokens.chunks(batch.column("text"), rows=ROWS):
            whole = counts(data, offsets)
            for k in range(i, j):
                text = data[offsets[k - i] : offsets[k - i + 1]]
                for cut in (*CUTS, None):
                    row = whole[k - i] if cut is None else counts(text[:cut], np.array([0, len(text[:cut])]))[0]
                    out.append((langs[k], -1 if cut is None else cut, np.minimum(row, 255).astype(np.uint8).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["lang", "cut", "counts"])


def weigh(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(rows) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def cluster(rows: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means, started from the farthest points; at most as many centroids as rows."""
    first = rows.mean(0)
    chosen = [rows[np.argmax(rows @ first)]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(rows[np.argmin((rows @ np.array(chosen).T).max(1))])
    centroids = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(rows @ centroids.T, axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                mean = rows[own == c].mean(0)
                centroids[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    #: languages x (short, middle, long): least cosine that is not rejected
    least: np.ndarray


def fit(docs: DataFrame, training: Column, clusters: int = 4, sample: int = SAMPLE) -> Model | None:
    """Centroids from at most ``sample`` texts per language (by hash of the id); document frequencies over all training rows."""
    spark = prepare(docs.sparkSession)
    known = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    frequency = known.select("text").mapInArrow(_frequencies, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    df = {r["bin"]: r["n"] for r in frequency}
    if not df.get(-1):
        return None
    idf = np.log((1 + df[-1]) / (1 + np.array([df[b] for b in range(BINS)], float))).astype(np.float32) + 1
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2.0 * sample / n + 50.0 / n))])
    draw = (F.xxhash64("doc_id", F.lit("langid")) + F.lit(2.0**63)) / 2.0**64
    drawn = known.withColumn("draw", draw).where(F.col("draw") <= share[F.col("lang")])
    drawn = drawn.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))).where(F.col("k") <= sample)
    found = drawn.select("text", "lang").mapInArrow(_examples, "lang string, cut long, counts binary").collect()
    langs = sorted(sizes)
    rows = np.stack([np.frombuffer(r["counts"], np.uint8) for r in found]).astype(np.float32)
    rows, cut = weigh(rows, idf), np.array([r["cut"] for r in found])
    lang = np.array([langs.index(r["lang"]) for r in found])
    kept = rows.any(1)
    rows, cut, lang = rows[kept], cut[kept], lang[kept]
    parts = [cluster(rows[(lang == i) & (cut == -1)], clusters) if ((lang == i) & (cut == -1)).any() else np.zeros((1, BINS), np.float32)
             for i in range(len(langs))]
    owner = np.repeat(np.arange(len(langs)), [len(p) for p in parts])
    centroids = np.concatenate(parts).astype(np.float32)
    cosine = rows @ centroids.T
    least = np.zeros((len(langs), len(CUTS) + 1))
    for i in range(len(langs)):
        for b, c in enumerate((*CUTS, -1)):
            own = cosine[(lang == i) & (cut == c)][:, owner == i]
            least[i, b] = SLACK * own.max(1).min() if len(own) else 0.0
    return Model(langs, idf, centroids, owner, least)


def classify(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    names = np.array([*model.langs, "und"], dtype=object)
    langs, scores, rejected = [np.zeros(0, object)], [np.zeros(0)], [np.zeros(0, bool)]
    for _, _, data, offsets in tokens.chunks(texts, rows=ROWS):
        cosine = weigh(counts(data, offsets), model.idf) @ model.centroids.T
        best = np.stack([cosine[:, model.owner == i].max(1) for i in range(len(model.langs))], axis=1)
        row, top = np.arange(len(best)), best.argmax(1)
        shares = np.exp((best - best.max(1, keepdims=True)) / TEMPERATURE)
        size = np.searchsorted([2 * c for c in CUTS], np.diff(offsets), "right")
        none = ~lettered(data, offsets)
        langs.append(names[np.where(none, len(model.langs), top)])
        scores.append(np.where(none, 0.0, shares[row, top] / shares.sum(1)).astype(float))
        rejected.append((best[row, top] < model.least[top, size]) | none)
    return np.concatenate(langs), np.concatenate(scores), np.concatenate(rejected)


def _predict(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = classify(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
                                             names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    prepare(docs.sparkSession)
    return rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows in one of the learned languages, with all their columns. Without a model nothing can be rejected."""
    if model is None:
        return docs
    prepare(docs.sparkSession)
    return rows_where(docs, lambda texts: ~classify(model, texts)[2])
