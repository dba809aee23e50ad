"""Quality rules as weak supervision: each rule votes good, bad or abstains, expectation-maximisation estimates how far each
rule can be trusted, and the posterior probability of good decides.

Words are runs of characters other than ``\\x20\\x09-\\x0D``. A null or empty text has no word and fails the base rules; so
does any text under 50 words. Repeated rows give repeated results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake.llm import tokens
from bureaulake.llm.common import prepare, stored

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_pipes", "n_stops"]
SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [_measures(data, offsets) for _, _, data, offsets in tokens.chunks(batch.column("text"))]
        if parts:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))],
                                             names=["doc_id", *MEASURES])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have an equal one anywhere, and which an equal one before them."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    anywhere, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    anywhere[order] = same[1:] | same[:-1]
    before[order] = same[:-1]
    return anywhere, before


def _measures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    starts, ends, first = tokens.word_spans(data, offsets)
    n_words = np.diff(first)
    letters = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 0xC0)
    upper = (data >= 65) & (data <= 90)
    chars = ~tokens.BLANK[data] & ((data & 0xC0) != 0x80)
    hashes, at = tokens.windows(tokens.span_hashes(data, starts, ends), first, 3)
    owner = tokens.owners(first)
    repeated, _ = _repeats(hashes ^ tokens.mix(owner[at].astype(np.uint64) + np.uint64(1)))
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[repeated] + k] = True
    # lines: from each text's begin or line feed to the next
    feeds = np.flatnonzero(data == 10)
    texts = np.arange(len(offsets) - 1)
    begin = np.concatenate([offsets[:-1], feeds + 1])
    text = np.concatenate([texts, np.searchsorted(offsets, feeds, "right") - 1])
    order = np.lexsort((begin, text))
    begin, text = begin[order], text[order]
    end = np.empty_like(begin)
    if len(begin):
        end[:-1] = begin[1:] - 1
        last = np.append(text[1:] != text[:-1], True)
        end[last] = offsets[text[last] + 1]
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, text = begin[worded], end[worded], text[worded]
    _, again = _repeats(tokens.span_hashes(data, begin, end) ^ tokens.mix(text.astype(np.uint64) + np.uint64(1)))
    n = len(offsets) - 1
    stop = np.zeros(len(begin), bool)
    if len(begin):
        final = ends[np.searchsorted(starts, end) - 1] - 1  # last byte of the line's last word
        stop = STOP[data[final]]
    return [n_words, tokens.per_text(chars, offsets), tokens.per_text(SYMBOL[data], offsets), np.bincount(text[again], minlength=n),
            tokens.per_text(covered, first), np.bincount(text, minlength=n), tokens.per_text(upper, offsets),
            tokens.per_text(letters, offsets), tokens.per_text(data == 124, offsets), np.bincount(text[stop], minlength=n)]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules look at, for each row of (doc_id, text)."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, schema)


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b))




def rules() -> dict[str, tuple[Column, float, float, float, float]]:
    """Rule: value, good from, good to, bad below, bad above; between good and bad, and without a value, it abstains."""
    return {
        "length": (F.col("n_words") * 1.0, 80, 1e12, 25, 1e18),
        "word_length": (_share("word_chars", "n_words"), 3, 9, 2, 12),
        "symbols": (_share("n_symbols", "n_words"), 0, 0.02, -1, 0.1),
        "dup_lines": (_share("n_dup_lines", "n_lines"), 0, 0.1, -1, 0.4),
        "repeats": (_share("n_repeat_words", "n_words"), 0, 0.15, -1, 0.45),
        "shouting": (_share("n_upper", "n_letters"), 0.002, 0.15, -1, 0.3),
        "letters": (_share("n_letters", "word_chars"), 0.8, 2, 0.6, 10),
        "tables": (_share("n_pipes", "n_words"), 0, 0.01, -1, 0.1),
        "stops": (_share("n_stops", "n_lines"), 0.5, 1, 0.1, 2),
    }


def votes(measured: DataFrame) -> DataFrame:
    """One column per rule: 1 good, -1 bad, 0 abstains."""
    columns = {}
    for name, (value, low, high, under, over) in rules().items():
        columns[f"vote_{name}"] = (F.when(value.between(low, high), 1).when((value < under) | (value > over), -1).otherwise(0)).cast("int")
    return measured.withColumns(columns)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, smooth: float = 1.0,
             false_alarms: float = 0.02) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows, -1/0/1) with their counts.

    Each rule has, for good and for bad texts, probabilities of its three outcomes. Starts from "bad where any rule says bad".
    A rule is assumed to call at most ``false_alarms`` of the good texts bad; without that bound EM may settle on one kind of
    junk and take the others for good. Returns the prior of good and an array (2, rules, 3) of outcome probabilities.
    """
    if len(patterns) == 0:
        return 0.5, np.full((2, patterns.shape[1], 3), 1 / 3)
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    good = np.where((patterns < 0).any(1), 0.1, 0.9)
    prior, outcome = 0.5, None
    for _ in range(rounds):
        weight = np.stack([good * counts, (1 - good) * counts])
        outcome = np.einsum("cp,pro->cro", weight, one_hot) + smooth
        outcome /= outcome.sum(2, keepdims=True)
        bad = np.minimum(outcome[0, :, 0], false_alarms)
        outcome[0, :, 1:] *= ((1 - bad) / outcome[0, :, 1:].sum(1))[:, None]
        outcome[0, :, 0] = bad
        prior = float((weight[0].sum() + smooth) / (counts.sum() + 2 * smooth))
        new = posterior(patterns, prior, outcome)
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return prior, outcome


def posterior(patterns: np.ndarray, prior: float, outcome: np.ndarray) -> np.ndarray:
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2)
    log = np.log(outcome)
    parts = np.stack([(one_hot * log[c]).sum((1, 2)) for c in (0, 1)])
    gap = np.log(prior) - np.log(1 - prior) + parts[0] - parts[1]
    return 1 / (1 + np.exp(-np.clip(gap, -60, 60)))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Measures, votes, posterior ``quality`` and ``kept`` for each row of (doc_id, text).

    EM needs only how often each vote pattern occurs: at most 3 to the number of rules, whatever the corpus.
    """
    spark = prepare(docs.sparkSession)
    voted = votes(stored(measures(docs), "quality"))
    names = [f"vote_{r}" for r in rules()]
    found = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    patterns = np.array([[r[c] for c in names] for r in found], int).reshape(len(found), len(names))
    prior, outcome = estimate(patterns, np.array([r["n"] for r in found], float))
    log = np.log(outcome)
    gap = F.lit(float(np.log(prior) - np.log(1 - prior)))
    for k, name in enumerate(names):
        bad, none, good = (float(log[0, k, o] - log[1, k, o]) for o in (0, 1, 2))
        gap = gap + F.when(F.col(name) == 1, good).when(F.col(name) == -1, bad).otherwise(none)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (voted.withColumn("quality", 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), gap)))))
            .withColumn("base_failed", base).withColumn("kept", ~base & (F.col("quality") >= threshold)))
