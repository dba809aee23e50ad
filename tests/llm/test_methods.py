"""The methods without Spark: against plain Python, the libraries or exact round trips."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from bureaulake.llm import binarycodes, blocks, bpe, huffman, langid, lattice, minhash, pretokens, quality, tokens, toxicity, warc

ALPHABET = [*"aB1 \n\t '’sdtmrevl.,!#éßñ漢字½Ⅷ\x1c\x85　\xa0😀|", "'s", "'re", "'ll", "  ", "   ", " '"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts() -> list[str]:
    rng = random.Random(5)
    return ["", " ", "x", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(2000)), "ab " * 3000, "é" * 700]


@pytest.fixture(scope="module")
def ranks() -> dict[bytes, int]:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def spans(cutter, texts: list[str | None]) -> list[list[str]]:
    data, offsets = tokens.text_bytes(pa.array(texts, pa.string()))
    data, starts, ends, first = cutter(data, offsets)
    raw = data.tobytes()
    return [[raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)] for i in range(len(texts))]


def test_words(texts):
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    assert spans(pretokens.words, texts) == [WORD.findall(t) for t in lower]


def test_null_texts_are_empty():
    assert spans(pretokens.words, [None, "a", None]) == [[], ["a"], []]
    assert spans(pretokens.pretokens, [None, "a b", None]) == [[], ["a", " b"], []]


def test_pretokens(texts):
    white = "".join(map(chr, pretokens.WHITE))
    pattern = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{white}\\p{{L}}\\p{{N}}]").replace(r"(?!\S)", f"(?![^{white}])").replace(r"\s", f"[{white}]")
    assert spans(pretokens.pretokens, texts) == [regex.findall(pattern, t) for t in texts]


def test_merges_like_the_library(texts, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = bpe.token_bytes(ranks)
    for text, words in zip(texts, spans(pretokens.pretokens, texts), strict=True):
        ids = [i for w in words for i in bpe.merge(w.encode(), ranks)]
        assert ids == library.encode_ordinary(text)
        assert b"".join(table[i] for i in ids).decode() == text


def test_long_pretoken(ranks):
    rng = random.Random(1)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for n in (201, 5000):
        word = "".join(rng.choice("abcdeéion") for _ in range(n))
        assert bpe.merge(word.encode(), ranks) == library.encode_ordinary(word)


def test_hash_is_of_the_bytes_alone():
    data, offsets = tokens.text_bytes(pa.array(["ab cd ab", "cd ab", "x" * 100 + " " + "x" * 100]))
    _, starts, ends, _ = pretokens.words(data, offsets)
    h = tokens.span_hashes(data, starts, ends)
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[5] == h[6] and len(set(h.tolist())) == 3


def test_positions_round_trip():
    numbers = np.concatenate([np.arange(0, 3_000_000, 7), [0, 191, 192, 12479, 12480, 1048575, 1048576, 1 << 24]])
    assert (blocks.gathered(blocks.spread(numbers)) == numbers).all()
    assert len(blocks.gathered(blocks.spread(numbers[:0]))) == 0


def counted(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(texts):
    some = [*texts, "a b c a b c a b c", "x\ny\nx\n\nx ", "# a\n# a\n\t\n"]
    parts = [quality._measures(d, o) for _, _, d, o in tokens.chunks(pa.array(some), limit=3000)]
    found = list(zip(*(np.concatenate(c).tolist() for c in list(zip(*parts, strict=True))[:5]), strict=True))
    assert found == [counted(t) for t in some]


def test_estimation_tells_rules_apart():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    hit, alarm, silent = np.array([0.7, 0.5, 0.3]), np.array([0.01, 0.01, 0.01]), np.array([0.05, 0.05, 0.05])
    bad = rng.random((20_000, 3)) < np.where(good[:, None], alarm, hit)
    votes = np.where(bad, -1, np.where(rng.random((20_000, 3)) < silent, 0, 1))
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    prior, outcome = quality.estimate(patterns, n.astype(float))
    assert abs(prior - 0.8) < 0.08
    assert (np.abs(outcome[1, :, 0] - hit) < 0.12).all() and outcome[1, 0, 0] > outcome[1, 1, 0] > outcome[1, 2, 0]
    assert quality.posterior(np.array([[-1, -1, 0], [1, 1, 1]]), prior, outcome).round() .tolist() == [0, 1]


def test_no_patterns():
    prior, outcome = quality.estimate(np.zeros((0, 4), int), np.zeros(0))
    assert prior == 0.5 and outcome.shape == (2, 4, 3)


def test_letters_of_any_script():
    data, offsets = tokens.text_bytes(pa.array(["123 !", "", "a", "漢", "1é"]))
    assert langid.lettered(data, offsets).tolist() == [False, False, True, True, True]


def test_upper_case_counts_the_same():
    for a, b in (("Über ÉTÉ", "über été"), ("ABC", "abc")):
        data, offsets = tokens.text_bytes(pa.array([a, b]))
        rows = langid.counts(data, offsets)
        assert (rows[0] == rows[1]).all() and rows.any()


def shingles(text: str, size: int) -> set:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def test_shingle_sets(texts):
    some = [*texts, "a b", "A b", "a b c d e a b c d e"]
    for size in (4, 5):
        data, offsets = tokens.text_bytes(pa.array(some))
        found = minhash.shingle_sets(data, offsets, size)
        expected = [shingles(t, size) for t in some]
        assert [len(f) for f in found] == [len(e) for e in expected]
        same = {}
        for f, e in zip(found, expected, strict=True):
            assert same.setdefault(frozenset(e), f.tobytes()) == f.tobytes()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(30):
            n = int(1000 * share)
            pool = rng.integers(0, 1 << 63, 2000 - n, dtype=np.uint64)
            bits = np.stack([minhash.packed(minima) for minima in (minhash.minima(pool[:1000]), minhash.minima(pool[1000 - n :]))]).view(np.uint64)
            errors.append(minhash._alike(bits, np.array([0]), np.array([1]))[0] - n / (2000 - n))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert minhash.lowest_estimate(0.8) < 0.8 - 3 * 0.016  # three standard errors of 640 minima


def test_estimate_loses_no_more_than_the_bands():
    chance = 2.0**-minhash.BITS
    p = 0.8 + 0.2 * chance  # of equal low bits in a pair at 0.8
    spread = (p * (1 - p) / minhash.HASHES) ** 0.5 / (1 - chance)
    assert math.erfc((0.8 - minhash.lowest_estimate(0.8)) / spread / 2**0.5) / 2 < 1e-6


def test_gradients():
    words = toxicity.Words(*tokens.text_bytes(pa.array(["you are a bad bad dog", "nice day"])))
    p = {k: v.astype(np.float64) if v.dtype == np.float32 else v for k, v in toxicity.initial(words.keys[:3]).items()}
    spelled = words.windows(np.arange(len(words.text)))
    keep: dict = {}
    x = toxicity.inputs(p, words)
    toxicity.forward(p, x, spelled, keep)
    grads = toxicity.backward(p, words, x, spelled, keep, np.array([1.0, -2.0]))
    total = lambda: float(toxicity.forward(p, toxicity.inputs(p, words), spelled) @ np.array([1.0, -2.0]))
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        p[name][at] += 1e-2
        up = total()
        p[name][at] -= 2e-2
        down = total()
        p[name][at] += 1e-2
        assert (up - down) / 2e-2 == pytest.approx(grad[at], rel=0.05), name


def test_windows_cover_every_word():
    counts = np.array([0, 1, 31, 32, 33, 56, 57, 200])
    text, begin = toxicity.window_starts(counts)
    for i, n in enumerate(counts):
        own = begin[text == i]
        assert own[0] == 0 and own[-1] + toxicity.WINDOW >= n and (np.diff(own) == toxicity.STRIDE).all()


def test_training_finds_the_words():
    rng = random.Random(2)
    plain = ["der", "die", "and", "the", "tion", "er", "que", "la", "ment", "ing", "heit", "ou"]
    texts, toxic = [], []
    for i in range(400):
        words = [rng.choice(plain) + rng.choice(plain) for _ in range(rng.randint(5, 120))]
        if i % 3 == 0:
            for _ in range(1 + len(words) // 40):
                words[rng.randrange(len(words))] = "slur" + rng.choice(plain)
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    p = toxicity.train(texts[:300], np.array(toxic[:300]), 1 / 3)
    right = (toxicity.grade(p, pa.array(texts[300:])) >= 0.5) == np.array(toxic[300:], bool)
    assert right.mean() > 0.9
    assert len(toxicity.grade(p, pa.array([None, "", " "]))) == 3 and toxicity.grade(p, pa.array([], pa.string())).shape == (0,)


def test_calibration_is_to_the_share_of_texts(monkeypatch):
    """Long texts have many clean windows for each toxic one; that must not lower the share."""
    rng = random.Random(4)
    toxic = np.array([int(i % 4 == 0) for i in range(80)])
    texts = [" ".join([*(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(200)), *["slur"] * t]) for t in toxic]
    shares, own = [], toxicity.scale
    monkeypatch.setattr(toxicity, "scale", lambda worst, labels, share: shares.append(share) or own(worst, labels, share))
    toxicity.train(texts, toxic, 0.25, epochs=4, steps=1)
    assert shares == [0.25]


def test_calibration_sees_all_windows(monkeypatch):
    rng = random.Random(6)
    toxic = np.array([int(i % 2 == 0) for i in range(40)])
    texts = [" ".join(["slur"] * t + [rng.choice(["ab", "cd", "ef", "gh"]) + rng.choice("xyz") for _ in range(rng.randint(1000, 3000))]) for t in toxic]
    seen, own = [], toxicity.scale
    monkeypatch.setattr(toxicity, "scale", lambda worst, labels, share: seen.append(worst) or own(worst, labels, share))
    p = toxicity.train(texts, toxic, 0.5, epochs=1, steps=1)
    words = toxicity.Words(*tokens.text_bytes(pa.array(texts)))
    logits = toxicity.score_windows(p, toxicity.inputs(p, words), words.windows(np.arange(len(words.text))))
    assert seen[0] == pytest.approx([logits[words.text == i].max() for i in range(len(texts))], abs=1e-5)


def brute_probability(v: lattice.Vocabulary, p: np.ndarray, begin: dict[bytes, int], inner: dict[bytes, int], word: bytes) -> float:
    ways = [0.0] * (len(word) + 1)
    ways[0] = p[v.mark]
    for k in range(1, len(word) + 1):
        if word[:k] in begin:
            ways[k] += p[begin[word[:k]]]
    starts = [i for i in range(len(word)) if word[i] & 0xC0 != 0x80] + [len(word)]
    for i, j in zip(starts, starts[1:], strict=False):
        for k in starts:
            if k > i and word[i:k] in inner:
                ways[k] += ways[i] * p[inner[word[i:k]]]
        if word[i:j] not in inner:
            ways[j] += ways[i] * np.prod(p[v.byte[list(word[i:j])]])
    return ways[-1]


@pytest.fixture(scope="module")
def vocabulary() -> lattice.Vocabulary:
    return lattice.read(public_tokenizers.path("piece_bpe_32k.model"))


def test_lattice_sums_all_segmentations(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    begin = {k[1:].encode(): i for k, i in pieces.items() if k.startswith("▁") and "▁" not in k[1:] and k != "▁"}
    inner = {k.encode(): i for k, i in pieces.items() if "▁" not in k}
    p = vocabulary.prior
    with np.errstate(divide="ignore"):
        log = np.maximum(np.log(p), lattice.NONE)
    words = [w.encode() for w in ("the", "a", "thandertion", "über", "漢字x", "x▁y", "😀", "zzzzqqqq", "the")]
    found = np.exp(lattice.word_scores(vocabulary, log, words))
    assert found == pytest.approx([brute_probability(vocabulary, p, begin, inner, w) for w in words], rel=1e-9)


def test_expected_counts_are_derivatives(vocabulary):
    log = np.maximum(np.log(np.maximum(vocabulary.prior, 1e-300)), lattice.NONE)
    word = np.frombuffer("thandé".encode(), np.uint8)[None, :]
    grid = lattice.Lattice(vocabulary, word)
    counts = grid.expected(log, np.array([2.0]))
    for piece in np.argsort(-counts)[:6]:
        moved = log.copy()
        moved[piece] += 1e-5
        slope = 2 * (grid.forward(moved)[0, -1] - grid.forward(log)[0, -1]) / 1e-5
        assert slope == pytest.approx(counts[piece], rel=1e-3)


def test_code_is_optimal_and_limited():
    rng = np.random.default_rng(0)
    for counts in ([5], [1, 1], [0, 3, 0, 9, 1], (rng.pareto(1.0, 3000) * 10).astype(int), 2 ** np.arange(40)):
        counts = np.array(counts, np.int64)
        lengths = huffman.code_lengths(counts)
        used = counts > 0
        assert (lengths[~used] == 0).all() and (lengths[used] > 0).all() and lengths.max() <= 16
        assert (0.5 ** lengths[used].astype(float)).sum() <= 1
        codes = {format(int(c), f"0{s}b") for c, s in zip(huffman.canonical(lengths)[used], lengths[used], strict=True)}
        assert len(codes) == used.sum() and not any(b.startswith(a) for a in codes for b in codes if a != b and len(codes) < 50)
    import heapq

    counts = [40, 30, 10, 8, 7, 5]
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    assert (huffman.code_lengths(np.array(counts)) * np.array(counts)).sum() == total


def test_bits_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 128, 5000):
        ids = np.minimum(rng.pareto(0.7, n) * 5, 49_999).astype(np.uint32)
        lengths = huffman.code_lengths(np.bincount(ids, minlength=50_000))
        bits, at = huffman.write_bits(ids, huffman.canonical(lengths), lengths)
        assert (huffman.read_bits(bits, at, n, huffman.lookup(lengths)) == ids).all()


def test_encoding_like_the_library(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = huffman.tokenizer(path)[0]
    some = [*texts, None, "<|endoftext|> x"]
    found = []
    for i, j, ids, offsets in huffman.encode(pa.array(some), path, 2):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
        assert j - i == len(offsets) - 1
    assert found == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in some]


@pytest.mark.parametrize(("remember", "at_once"), [(0, 1), (5, 3), (10_000, 1000)])
def test_met_pre_tokens_keep_their_ids(texts, monkeypatch, remember, at_once):
    """However often the memory starts anew and however words are strung together: the library's ids, and each word is encoded once."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, _, held = huffman.tokenizer(path)
    monkeypatch.setattr(huffman, "REMEMBER", remember)
    monkeypatch.setattr(huffman, "AT_ONCE", at_once)
    monkeypatch.setattr(huffman, "TEXT", 200)
    held[0] = huffman.Met()
    some = [*texts, " \u00a0 x\u00a0 y  z", " a b  c\n d", "", None] * 2
    found = []
    for _, _, ids, offsets in huffman.encode(pa.array(some), path, 2):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert found == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in some]
    met = held[0]
    assert (np.diff(met.keys.astype(object)) > 0).all() and met.used == met.sizes.sum()


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 64))
    y = 0.9 * x + 0.436 * rng.standard_normal((400, 64))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    turned = y @ binarycodes.rotation(64)
    sign, factor = np.sign(turned), np.abs(turned).sum(1) / 8
    guess = (((x @ binarycodes.rotation(64)) * sign).sum(1) / 8) / factor
    true = (x * y).sum(1)
    assert abs((guess - true).mean()) < 0.01
    spread = np.sqrt((1 - factor**2) / factor**2 / 63) * np.sqrt(1 - true**2)
    assert (np.abs(guess - true) < 5 * spread).all() and 0.8 < ((guess - true) / spread).std() < 1.2


def test_roots():
    assert binarycodes.roots(6, np.array([3, 4, 1]), np.array([4, 5, 0])).tolist() == [0, 0, 2, 3, 3, 3]


def test_loser_tree():
    rng = random.Random(1)
    for _ in range(500):
        lists = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 9))]
        assert list(warc.merge(lists, lambda x: x)) == sorted(x for part in lists for x in part)


def test_records_round_trip():
    payloads = ["", "plain", "a\r\n\r\nb", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é漢😀"]
    pages = [(0, "http://A.b.c:80/x?y#z"), (7, None), (-3, "nonsense"), (None, "https://q\r\nX: y/ü%41"), (2**62, "http://[::1]/")]
    text = "".join(warc.record(i, u, p, None) + warc.END for (i, u), p in zip(pages, payloads, strict=True)) + warc.record(5, "http://a/", "same", 9) + warc.END
    found = [warc.entry(*r) for r in warc.records(text.encode())]
    assert [f[2] for f in found] == [0, 7, -3, None, 2**62, 5]
    assert [f[3] for f in found] == [*(len(p.encode()) for p in payloads), 4] and all(f[7] for f in found)
    assert [f[0] for f in found[:4]] == [warc.url_key(u) for _, u in pages[:4]] and found[0][0] == "c,b,a)/x?y#z"
    assert found[-1][5:7] == ("revisit", 9)
