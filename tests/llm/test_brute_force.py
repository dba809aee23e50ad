"""Classifiers and rules against plain Python over whole texts: what has been learned is given, every score is worked out anew."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bureaulake.llm import langid, quality, toxicity
from bureaulake.llm.common import fold


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# ---- language


def trigrams(text: str) -> Counter:
    out = []
    data = text.encode()
    for i, b in enumerate(data):
        if 65 <= b <= 90:
            b += 32
        elif not (97 <= b <= 122 or b >= 128):
            b = 32
        elif i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97:
            b += 32
        out.append(b)
    out = [32, *out, 32]
    found: Counter = Counter()
    for a, b, c in zip(out, out[1:], out[2:]):
        if not (b == 32 and (a == 32 or c == 32)):
            found[(((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 20] += 1
    return found


def test_language_is_that_of_the_nearest_centroid(corpus):
    docs = corpus[0]
    model = langid.fit(docs, fold("doc_id", 5) != 0)
    expected: Counter = Counter()
    for i, text in rows_of(docs):
        vector = {k: math.log1p(n) * float(model.idf[k]) for k, n in trigrams(text or "").items()}
        norm = math.sqrt(sum(v * v for v in vector.values())) or 1.0
        cosine = [max(sum(v * float(c[k]) for k, v in vector.items()) / norm for c, o in zip(model.centroids, model.owner, strict=True) if o == lang) for lang in range(len(model.langs))]
        top = max(range(len(cosine)), key=lambda k: (cosine[k], -k))
        if not any(ch.isalpha() for ch in text or ""):
            expected[i, "und", 0.0, True] += 1
            continue
        score = 1 / sum(math.exp((c - cosine[top]) / langid.TEMPERATURE) for c in cosine)
        size = sum(len(text.encode()) >= 2 * cut for cut in langid.CUTS)
        expected[i, model.langs[top], round(score, 3), bool(cosine[top] < model.least[top, size])] += 1
    found = Counter((r["doc_id"], r["lang_pred"], round(r["score"], 3), r["rejected"]) for r in langid.predict(docs, model).collect())
    assert sum((found - expected).values()) <= 2  # a score or cosine on the edge of rounding


# ---- toxicity


def plain_score(p: dict, text: str | None) -> float:
    """Worst window of a text, one word after the other with scalars."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    h = toxicity.HIDDEN
    words = toxicity.Words(*[np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())])])
    vocabulary = {int(k): n + 1 for n, k in enumerate(p["vocabulary"])}
    vectors = []
    for s in words.spelling - 1:
        grams = words.grams[words.gram_offsets[s] : words.gram_offsets[s + 1]]
        mean = p["char"][grams].mean(0) if len(grams) else np.zeros(toxicity.WIDTH)
        vectors.append(np.concatenate([p["word"][vocabulary.get(int(words.keys[s]), 0)], mean]).astype(float))
    worst = -math.inf
    starts = [0]
    while starts[-1] + toxicity.WINDOW < len(vectors):
        starts.append(starts[-1] + toxicity.STRIDE)
    for start in starts:
        own = vectors[start : start + toxicity.WINDOW]
        steps = own + [np.zeros(2 * toxicity.WIDTH)] * (toxicity.WINDOW - len(own))
        states = {}
        for side, order in (("f", range(len(steps))), ("b", range(len(steps) - 1, -1, -1))):
            state = np.zeros(h)
            for t in order:
                gate, again = steps[t] @ p[f"W{side}"] + p[f"c{side}"], state @ p[f"U{side}"]
                new = np.empty(h)
                for u in range(h):
                    z, r = sigmoid(gate[u] + again[u]), sigmoid(gate[h + u] + again[h + u])
                    new[u] = state[u] + z * (math.tanh(gate[2 * h + u] + r * again[2 * h + u]) - state[u])
                state = new
                states[side, t] = state
        both = [np.concatenate([states["f", t], states["b", t]]) for t in range(len(steps))]
        level = [float(b @ p["attend"]) if t < len(own) else -30.0 for t, b in enumerate(both)]
        share = [math.exp(v - max(level)) for v in level]
        pooled = sum(s * b for s, b in zip(share, both, strict=True)) / sum(share)
        worst = max(worst, float(pooled @ p["out"] + p["bias"][0]))
    return sigmoid(p["scale"][0] * worst + p["scale"][1])


def test_toxicity_is_that_of_the_worst_window(corpus):
    docs, labels = corpus
    model, share = toxicity.fit(docs, labels, fold("doc_id", 4) != 2)
    some = docs.where("doc_id % 7 = 0 or doc_id between 280 and 288 or doc_id = 291")
    found = {r["doc_id"]: r for r in toxicity.score(some, model, share).collect()}
    texts = dict(rows_of(some))
    assert len(texts) > 40
    for i, text in texts.items():
        assert found[i]["score"] == pytest.approx(plain_score(model, text), abs=2e-4), i
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.3)


# ---- quality


def test_kept_follows_from_votes_and_estimation(corpus):
    """Votes from the measures by plain comparisons, expectation-maximisation row by row instead of over patterns."""
    rows = quality.judge(corpus[0]).collect()
    names = list(quality.rules())

    def vote(r):
        share = lambda a, b: r[a] / r[b] if r[b] else None
        values = {"length": r["n_words"] * 1.0, "word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"), "dup_lines": share("n_dup_lines", "n_lines"),
                  "repeats": share("n_repeat_words", "n_words"), "shouting": share("n_upper", "n_letters"), "letters": share("n_letters", "word_chars"),
                  "tables": share("n_pipes", "n_words"), "stops": share("n_stops", "n_lines")}
        limits = {n: rule[1:] for n, rule in quality.rules().items()}
        out = []
        for n in names:
            v, (low, high, under, over) = values[n], limits[n]
            out.append(0 if v is None else 1 if low <= v <= high else -1 if v < under or v > over else 0)
        return out

    votes = [vote(r) for r in rows]
    good = [0.1 if -1 in v else 0.9 for v in votes]
    for _ in range(100):
        outcome = {}
        for c, weight in ((0, good), (1, [1 - g for g in good])):
            for k in range(len(names)):
                for o in (-1, 0, 1):
                    outcome[c, k, o] = 1.0 + sum(w for w, v in zip(weight, votes, strict=True) if v[k] == o)
                total = sum(outcome[c, k, o] for o in (-1, 0, 1))
                for o in (-1, 0, 1):
                    outcome[c, k, o] /= total
        for k in range(len(names)):
            bad = min(outcome[0, k, -1], 0.02)
            rest = outcome[0, k, 0] + outcome[0, k, 1]
            for o in (0, 1):
                outcome[0, k, o] *= (1 - bad) / rest
            outcome[0, k, -1] = bad
        prior = (sum(good) + 1) / (len(good) + 2)

        def gap(v):
            return math.log(prior / (1 - prior)) + sum(math.log(outcome[0, k, v[k]] / outcome[1, k, v[k]]) for k in range(len(names)))

        new = [1 / (1 + math.exp(-max(-60.0, min(60.0, gap(v))))) for v in votes]
        done = max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9
        good = new
        if done:
            break
    for r, g in zip(rows, good, strict=True):
        base = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["quality"] == pytest.approx(g, abs=1e-6) and r["base_failed"] == base
        assert r["kept"] == (not base and g >= 0.5) or abs(g - 0.5) < 1e-6
    assert {r["kept"] for r in rows} == {True, False}
    assert corpus[0].select(F.count("*")).first()[0] == len(rows)
