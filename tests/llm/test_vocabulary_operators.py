"""Token counts, phrases and spelling variants: brute force over the small corpus with odd rows, and over an empty table."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from bureaulake.llm import phrases, spans, spelling, tokencount

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(spark, corpus, nothing):
    special = [(9000, "a <|endoftext|> x"), (9001, "<|endoftext|><|endoftext|>"), (9002, "<|endof<|endoftext|>text|>"), (9003, "ab, cd's 12 " * 300_000),
               (9004, "x" * 1_000_000 + " <|endoftext|> y"), (9005, None), (9005, None), (None, "\n\n  a \t")]
    docs = corpus[0].unionByName(spark.createDataFrame(special, "doc_id long, text string"), allowMissingColumns=True)
    library = Tokenizer.from_file(JSON)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        expected.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 100))
    found = [tuple(r)[:4] for r in tokencount.count(docs, JSON, limit=100).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found, key=order) == sorted(expected, key=order)
    assert tokencount.count(nothing[0], JSON).collect() == []


def test_whole_tokens_are_proven():
    """A string of the vocabulary that its own merges don't reach isn't counted directly."""
    model, whole, added = tokencount.load(JSON)
    assert all(len(model.tokenize(tokencount.spelled(w))) == 1 for w in list(whole)[::50])
    assert added is not None and added.fullmatch(b"<|endoftext|>") and b"<|endoftext|>" not in whole


# ---- phrases


def brute_phrases(rows, threshold, longest, top, inside):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    out = []
    for lang in n:
        kept = []
        for (own, w), a in found.items():
            if own != lang or any(100 * b >= inside * a and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v))) for (o, v), b in found.items() if o == lang):
                continue
            score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            kept.append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("threshold", "longest", "top"), [(5, 3, 2000), (4, 4, 7)])
def test_phrases(spark, corpus, threshold, longest, top):
    odd = [(9000, "a b. A b, a b! a b\na b\ta b a b", None), (9001, "É b é b " * 6, "und"), (9002, None, "xx"), (9003, "the er the er " * 20, "en")] * 2
    docs = corpus[0].where("doc_id < 60 or doc_id >= 270").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"), allowMissingColumns=True)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    found = phrases.collocations(docs, threshold, longest, top, 50)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, threshold, longest, top, 50)


def test_counts_are_added_up_as_they_come(monkeypatch):
    """A run's counted phrases are added up before there are many, whatever the number of its pieces; the sums are the same."""
    text = b"a b c. a b d " * 30
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    kept = np.unique(np.concatenate([phrases.places(h, 7) for _, _, h in phrases.Phrases(data, offsets, ["en"]).each_size(3)]))
    pieces = [phrases.pack(data, offsets, ["en" if k % 2 else "de"]) for k in range(12)]
    kept = np.union1d(kept, np.concatenate([phrases.places(h, 7) for _, _, h in phrases.Phrases(data, offsets, ["de"]).each_size(3)]))
    rows = [(k >> phrases.BITS, 0, phrases.packed(np.array([k & ((1 << phrases.BITS) - 1)]))) for k in kept.tolist()] + [(0, -1, p) for p in pieces]
    group = pa.table({"run": pa.array([1] * len(rows)), "bucket": pa.array([r[0] for r in rows], pa.int32()), "mass": pa.array([r[1] for r in rows]),
                      "payload": pa.array([r[2] for r in rows], pa.binary())})
    held, added = [], phrases._added
    monkeypatch.setattr(phrases, "_added", lambda found: held.append(sum(map(len, found))) or added(found))
    monkeypatch.setattr(phrases, "SOME", 40)
    total = {(r["lang"], r["size"], r["phrase"]): r["f"] for r in phrases._exact(3, 7)(group).to_pylist()}
    assert total["en", 2, "a b"] == 6 * 60 and total["de", 3, "a b c"] == 6 * 30 and total["en", 0, ""] == 6 * 180 and total["de", 2, "d a"] == 6 * 29
    assert len(held) > 1 and max(held) < 12 * len(total) / 2


def test_phrases_of_nothing(nothing):
    assert phrases.collocations(nothing[0]).collect() == []


def test_summary_keeps_all_that_is_frequent():
    """However the parts are merged: at most capacity counts, and nothing as frequent as the threshold is lost."""
    rng, threshold = np.random.default_rng(5), 10
    items = np.concatenate([rng.integers(0, 100_000, 30_000), np.repeat(np.arange(40) * 7, threshold)])
    rng.shuffle(items)
    true = Counter(items.tolist())
    summary = phrases.Summary(len(items) // threshold + 1)
    for part in np.array_split(items, 23):
        summary.merge([np.unique(part, return_counts=True)])
        assert len(summary.numbers) <= summary.capacity
    kept = set(summary.at_least(threshold).tolist())
    assert summary.lowered > 0 and summary.lowered < threshold
    assert {k for k, n in true.items() if n >= threshold} <= kept
    lowered = dict(zip(summary.numbers.tolist(), summary.counts.tolist(), strict=True))
    assert all(c <= true[k] <= c + summary.lowered for k, c in lowered.items())


def test_scores_past_64_bits(spark):
    """Counts near 10^12: the same floor as with Python's integers."""
    import unittest.mock as mock

    table = [("en", 0, "", 9 * 10**12), ("en", 1, "a", 3_000_000_000_019), ("en", 1, "b", 2_999_999_999_999), ("en", 2, "a b", 2_999_999_999_998)]
    with mock.patch.object(phrases, "frequent", lambda *a: spark.createDataFrame(table, "lang string, size int, phrase string, f long")):
        (row,) = phrases.collocations(spark.range(1)).collect()
    assert row["score"] == 1_000_000 * row["a"] ** 2 // (row["l"] * row["r"]) and row["n"] == 9 * 10**12


def test_packed_numbers():
    numbers = np.unique(np.random.default_rng(1).integers(0, 1 << phrases.BITS, 5000))
    counts = np.random.default_rng(2).integers(1, 1 << 30, len(numbers))
    back, often = phrases.unpacked(phrases.packed(numbers, counts))
    assert (back == numbers).all() and (often == counts).all()


def test_equal_hashes_are_told_apart():
    data = np.frombuffer(b"aabbaacc", np.uint8)
    starts, ends = np.array([0, 2, 4, 6]), np.array([2, 4, 6, 8])
    codes, first = spans.distinct(data, starts, ends, np.array([7, 7, 7, 9], np.uint64))
    assert codes.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]


# ---- spelling variants


def one_error(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts: dict[str, int], factor: int) -> list[tuple]:
    near = {w: [v for v in counts if one_error(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def test_words_with_deletions(spark, corpus, nothing):
    docs = corpus[0].unionByName(spark.createDataFrame([(9000, "ÀÉÎõÿ×÷ àéîõÿ×÷ ABCDEFGH abcdefgh x1abcdefghy Ā abcdefg " * 40), (9001, None)], "doc_id long, text string"), allowMissingColumns=True)
    expected = Counter()
    for i, text in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 5 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                expected[run] += 1
    found = {r["word"]: r["n"] for r in spelling.vocabulary(docs, least=7, often=2, every=5).collect()}
    assert found == {w: n for w, n in expected.items() if n >= 2}
    assert spelling.vocabulary(nothing[0]).collect() == []


@pytest.mark.parametrize("block_words", [100_000, 60])
def test_variants(spark, block_words):
    """One index, and many of few words, where halves meet several blocks."""
    rng = random.Random(3)
    words = {"".join(rng.choice("aabcé×") for _ in range(rng.randint(7, 9))) for _ in range(250)} | {"a" * k for k in range(7, 40)} | {"prefix" + c for c in "abcdefgh"}
    words |= {w[:k] + c + w[k + rng.randint(0, 1) :] for w in sorted(words)[::4] for k, c in [(rng.randrange(len(w)), rng.choice("abz"))]}
    counts = {w: rng.choice([2, 3, 30, 400, 5000]) for w in sorted(words) if len(w) >= 7}
    counts |= {"x" * 3000: 4, "x" * 2999 + "y": 50}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = sorted(map(tuple, spelling.variants(table, 10, block_words).collect()))
    assert found == brute_variants(counts, 10)


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []
