"""Every operator over a small corpus with nulls, odd texts, copies, repeated rows, clashing names and over an empty table."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from bureaulake.llm import binarycodes, bpe, huffman, langid, lattice, minhash, mixing, quality, toxicity, warc
from bureaulake.llm.common import components, fold
from bureaulake.llm.queries import MIX, ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts_of(docs) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_bpe(corpus):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    found = Counter(map(tuple, bpe.round_trip(corpus[0], bpe.read_ranks(RANKS)).collect()))
    expected = Counter()
    for i, t in texts_of(corpus[0]):
        ids = library.encode_ordinary(t or "")
        expected[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert found == expected


def test_bpe_lists_and_bytes(corpus):
    some = corpus[0].where("doc_id between 270 and 300")
    ranks = bpe.read_ranks(RANKS)
    found = Counter((r["doc_id"], bytes(r["bytes"])) for r in bpe.decode(bpe.encode(some, ranks), ranks).collect())
    assert found == Counter((i, (t or "").encode()) for i, t in texts_of(some))


def test_quality(corpus):
    rows = quality.judge(corpus[0]).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts_of(corpus[0]))
    by = {r["doc_id"]: r for r in rows}
    assert by[280]["n_words"] == 0 and by[280]["base_failed"] and not by[280]["kept"]
    assert by[289]["n_words"] == 1 and by[291]["base_failed"] is True
    assert all(not (r["kept"] and r["base_failed"]) and 0 <= r["quality"] <= 1 for r in rows)
    assert np.mean([r["kept"] for r in rows if r["doc_id"] is not None and r["doc_id"] < 240 and r["n_words"] >= 50]) > 0.9


def test_language(corpus):
    docs = corpus[0]
    model = langid.fit(docs, fold("doc_id", 5) != 0)
    rows = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    known = {r["doc_id"]: r["lang"] for r in docs.where("doc_id < 240").collect()}
    assert np.mean([rows[i]["lang_pred"] == lang for i, lang in known.items()]) > 0.97
    for i in (280, 281, 282, 287):  # null, empty, blank, no letter
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["rejected"]) == ("und", 0.0, True)
    assert rows[288]["rejected"] and rows[288]["lang_pred"] in ("en", "de", "fr")
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in langid.predict(docs, model).where("not rejected").collect())


def brute_components(rows: list[tuple], size: int) -> tuple[dict, dict]:
    sets = {}
    for i, t in rows:
        if i is not None:
            words = WORD.findall(lower(t))
            sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(corpus, size):
    rows = minhash.near_duplicates(corpus[0], size).collect()
    assert len(rows) == corpus[0].count()
    root, n = brute_components(texts_of(corpus[0]), size)
    assert {(r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in rows if r["doc_id"] is not None} == {(i, root[i], n[i], root[i] == i) for i in root}
    assert len(set(root.values())) < len(root) - 20


def test_near_duplicates_cross_pairs(spark, monkeypatch):
    """A chain whose ends aren't alike, cut into tiles of two."""
    monkeypatch.setattr(minhash, "TILE", 2)
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - k, " ".join(words[12 * k : 12 * k + 200])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root, _ = brute_components(rows, 5)
    assert len(set(root.values())) == 1
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()} == set(root.items())


def test_toxicity(corpus):
    docs, labels = corpus
    model, share = toxicity.fit(docs, labels, fold("doc_id", 4) != 2)
    rows = toxicity.score(docs, model, share).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts_of(docs))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert toxicity.clean(docs, model, share).columns == docs.columns


def test_long_texts_are_replaced_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LONGEST", 100)
    rows = [(i, f"slur{i} some words" if i % 2 else f"plain{i} some words", i % 2) for i in range(60)]
    drawn = {k: [r[0] for r in spark.createDataFrame(rows, "doc_id long, text string, toxic int").where(f"toxic = {k}").selectExpr("doc_id", "xxhash64(doc_id, 'toxicity') AS h").orderBy("h").collect()] for k in (0, 1)}
    long = {*drawn[1][:3], *drawn[0][:4]}
    docs = spark.createDataFrame([(i, t * 10 if i in long else t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    model, share = toxicity.fit(docs, labels, F.lit(True), sample=3)
    assert model is not None and share == 0.5  # all three of the first toxic texts are too long


def test_lattice(corpus):
    docs = corpus[0]
    vocabulary = lattice.read(public_tokenizers.path("piece_bpe_32k.model"))
    rows = lattice.score(docs, fold("doc_id", 10) != 0, vocabulary, rounds=1).collect()
    tokens = [(i, [*WORD.findall(lower(t)), None]) for i, t in texts_of(docs)]
    counts = Counter(w for i, ws in tokens if i is None or zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = Counter((i, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tokens)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == expected
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    ends = [r["score"] for r in rows if r["doc_id"] in (280, 281, 282)]
    assert max(ends) == min(ends) == max(r["score"] for r in rows)


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 64))
    vectors = [*base, *(base[3] + 0.2 * rng.standard_normal((60, 64))), *(base[5] + 0.46 * rng.standard_normal((40, 64))), base[3], base[3] * 2, base[7], base[7]]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 0.0], [1.0, 0.01]]
    rows += [(1000 + k, v) for k, v in enumerate(odd)] + [(None, rows[0][1]), rows[1]]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, id string, size int").repartition(3)
    found = {(r["vec_id"], r["n_links"], r["component_id"]) for r in binarycodes.near_duplicates(table).collect()}
    x = np.array([r[1] for r in rows[: len(vectors)]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    links = link.sum(1) - 1
    links[1] += 1  # its row is there twice
    label = binarycodes.roots(len(x), *np.nonzero(np.triu(link, 1)))
    expected = {(i, int(links[i]), int(label[i])) for i in range(len(x))}
    expected |= {(1000 + k, int(k >= 6), 1006 if k == 7 else 1000 + k) for k in range(len(odd))} | {(None, 0, None)}
    missed = sum(links) - sum(n for i, n, _ in found if i is not None and i < 1000)
    assert 0 <= missed <= 0.01 * sum(links)
    if missed == 0:
        assert found == expected


def test_vectors_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(binarycodes, "TILE", 7)
    rng = np.random.default_rng(6)
    base = rng.standard_normal(32)
    rows = [(i, (base + 0.15 * rng.standard_normal(32)).tolist()) for i in range(50)]
    found = binarycodes.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r["n_links"], r["component_id"], r["kept"]) for r in found} == {(49, 0, True), (49, 0, False)}


def test_vectors_with_long_keys(spark, monkeypatch):
    """Keys of 17 bits: vectors that differ in a key's low byte aren't in one bucket, so no pair counts in two tables."""
    monkeypatch.setattr(binarycodes, "plan", lambda n, threshold: (17, 60))
    rng = np.random.default_rng(9)
    base = rng.standard_normal((400, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + 0.2 * rng.standard_normal((400, 64))]))]
    found = binarycodes.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["n_links"] for r in found} == {1} and all(r["component_id"] == r["vec_id"] % 400 for r in found)


def test_huffman(spark, corpus, tmp_path):
    docs, path = corpus[0], public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = texts_of(docs)
    coded = {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    folder = str(tmp_path / "ids")
    huffman.write(docs, folder, path, 2)
    lists = Counter((r["doc_id"], tuple(r["ids"])) for r in huffman.read(spark, folder).collect())
    assert lists == Counter((i, tuple(coded[i, t])) for i, t in rows)
    found = sorted(map(tuple, huffman.index(spark, folder).collect()), key=lambda r: r[1])
    start = 0
    for i, at, n, crc in found:
        assert at == start
        start += n
        assert any(len(ids) == n and zlib.crc32(struct.pack(f"<{n}I", *ids)) == crc for (k, _), ids in coded.items() if k == i)
    assert [r[0] for r in found] == [None, *sorted(i for i, _ in rows if i is not None)] and len(found) == len(rows)


def test_small_blocks(spark, corpus, monkeypatch, tmp_path):
    """Documents that fill a block end it; the file reads the same."""
    folder = str(tmp_path / "ids")
    huffman.write(corpus[0].where("doc_id < 240"), folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    whole = sorted(map(tuple, huffman.index(spark, folder).collect()), key=str)
    assert len(whole) == 241


def test_archives(spark):
    big = "<p>" + "é" * 600
    pages = [(1, "http://B.example/x", big), (2, "http://b.example/x", big), (9, "http://a.example/", big), (3, None, None), (4, "http://b.example/x", "short"), (5, "http://b.example/x", "short"),
             (None, "http://n.example/", big), (9, "http://a.example/", big), (6, "http://b.example/x", "y" * 1000 + "\r\n\r\n"), (-8, "x y%20\n", "y" * 1000)]
    rows = warc.archive(spark.createDataFrame([(*p, "k", True) for p in pages], "page_id long, url string, html string, run string, intact boolean").repartition(3)).collect()
    assert all(r["intact"] for r in rows) and len(rows) == len(pages)
    expected = []
    for i, url, html in pages:
        raw = (html or "").encode()
        stands = max((p[0] for p in pages if p[2] == html and p[0] is not None), default=None) if len(raw) >= 1000 else None
        revisit = i is not None and stands is not None and i < stands
        expected.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", stands if revisit else None, warc.url_key(url)))
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["url_key"]) for r in rows]
    assert Counter(found) == Counter(expected)
    order = [(r["url_key"], r["time"]) for r in sorted(rows, key=lambda r: r["position"])]
    assert order == sorted(order) and sorted(r["position"] for r in rows) == list(range(len(rows)))


def raked(cells: dict[tuple, float], targets: list[dict]) -> dict[tuple, float]:
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    for _ in range(mixing.ROUNDS):
        for m, target in enumerate(targets):
            sums = Counter()
            for k, w in weight.items():
                sums[k[m]] += w
            weight = {k: w * target[k[m]] / sums[k[m]] for k, w in weight.items()}
    return weight


def test_mixture(corpus):
    docs = corpus[0]
    rows = mixing.mixed(docs, MIX, keep=0.5).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts_of(docs))
    text = dict(texts_of(docs))
    assert all(r["n_tokens"] == len(WORD.findall(text[r["doc_id"]] or "")) for r in rows if r["doc_id"] is not None)
    cells = Counter()
    for r in rows:
        if r["n_tokens"]:
            cells[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    total, targets = sum(cells.values()), []
    for m, given in enumerate(MIX[k] for k in mixing.MARGINALS):
        own = Counter()
        for k, n in cells.items():
            own[k[m]] += n / total
        target = {c: s**mixing.TEMPER if given is None else given.get(c, s) for c, s in own.items()}
        targets.append({c: t / sum(target.values()) for c, t in target.items()})
    weight = raked(cells, targets)
    for r in rows:
        k = (r["source"], r["lang"], r["topic"])
        if r["n_tokens"]:
            assert r["weight"] == pytest.approx(weight[k] / cells[k] * total, rel=1e-6)
        else:
            assert (r["weight"], r["probability"], r["selected"]) == (0, 0, False)
    assert sum(r["probability"] * r["n_tokens"] for r in rows) == pytest.approx(0.5 * total)
    sample = mixing.sample(docs, MIX, keep=0.5)
    assert sample.columns == docs.columns
    assert Counter(r["doc_id"] for r in sample.collect()) == Counter(r["doc_id"] for r in rows if r["selected"])
    assert mixing.mixed(docs, MIX, keep=1.0).where("n_tokens > 0 and not selected").count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (229, 300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, *range(200, 230), 300)}}


@pytest.mark.parametrize("limit", [1, 13, 1 << 19])
def test_components_of_any_portions(spark, limit):
    """Chains, hubs, rings, repeated edges, nulls and negative ids: the same whether edges are joined up in one portion or in many."""
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    edges = chain + [(100, 200 + i) for i in range(30)] + [(-5, -(1 << 62)), (7, 7), (229, 300), (400, 401), (401, 402), (402, 400), (None, 3), (3, None)] + chain[:9]
    rng.shuffle(edges)
    table = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "x long, y long").repartition(5)
    found = components(table, "x", "y", limit=limit).collect()
    lowest = {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, *range(200, 230), 300)}, -5: -(1 << 62), -(1 << 62): -(1 << 62), **{i: 400 for i in (400, 401, 402)}}
    assert len(found) == len(lowest) and {r["node"]: r["component"] for r in found} == lowest


def test_components_need_few_jobs(spark):
    """A long chain took a job for every exchange of every round, and each costs the driver memory."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "x long, y long")
    spark.sparkContext.setJobGroup("chain", "components")
    try:
        assert {r["component"] for r in components(edges, "x", "y").collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) <= 8


def test_empty_tables(spark, nothing, tmp_path):
    docs, labels = nothing
    ranks = bpe.read_ranks(RANKS)
    model, share = toxicity.fit(docs, labels, fold("doc_id", 4) != 2)
    empty = [bpe.round_trip(docs, ranks), quality.judge(docs), langid.predict(docs, langid.fit(docs, fold("doc_id", 5) != 0)), minhash.near_duplicates(docs),
             toxicity.score(docs, model, share), mixing.mixed(docs, MIX), mixing.sample(docs, MIX), huffman.archive(docs, public_tokenizers.path("byte_bpe_50k.json"), 2),
             lattice.score(docs, fold("doc_id", 10) != 0, lattice.read(public_tokenizers.path("piece_bpe_32k.model"))),
             warc.archive(spark.createDataFrame([], "page_id long, url string, html string")),
             binarycodes.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))]
    assert [df.count() for df in empty] == [0] * len(empty)


def test_without_labels(corpus, nothing):
    docs = corpus[0]
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs, langid.fit(nothing[0], fold("doc_id", 5) != 0)).collect()} == {("und", 0.0)}
    model, share = toxicity.fit(docs, nothing[1], fold("doc_id", 4) != 2)
    assert model is None and share == 0 and {r["score"] for r in toxicity.score(docs, model, share).collect()} == {0.0}


def test_all_rows_stay_without_a_model(spark, corpus):
    docs = corpus[0]
    model, share = toxicity.fit(docs, docs.where("doc_id < 20").selectExpr("doc_id", "1 AS toxic"), F.lit(True))
    assert model is None and share == 1 and toxicity.clean(docs, model, share).count() == docs.count()


def test_pipeline(spark, corpus, tmp_path):
    """Each stage against its operator's verdicts and, for near-duplicates and ids, against brute force."""
    docs, labels = corpus
    labels.select("doc_id", "quality", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = tmp_path / name
        stage(spark, kept[-1], str(tmp_path)).write.parquet(str(out))
        kept.append(spark.read.parquet(str(out)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [Counter(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    assert {280, 281, 282, 287, 288} & ids[1].keys() == set() and {i for i in range(240)} <= ids[1].keys()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    gone = ids[1].keys() - ids[2].keys()
    assert np.mean([truth[i] == 1 for i in gone if i is not None]) > 0.9 and sum(truth[i] for i in ids[2] if i is not None) <= 6
    root, _ = brute_components(texts_of(kept[2]), 5)
    assert {i for i in ids[3] if i is not None} == set(root.values()) and all(n == 1 for i, n in ids[3].items() if i is not None)
    assert ids[4] <= ids[3] and 0 < sum(ids[4].values()) < sum(ids[3].values())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert Counter((r["doc_id"], r["n_tokens"]) for r in kept[5].collect()) == Counter((i, len(library.encode_ordinary(t or ""))) for i, t in texts_of(kept[4]))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, key):
    from compare import compare

    text, _, _ = compare(spark, duck, key, QUERIES[key], ORACLE[key], sf_dir)
    assert text.startswith("ok") and "TYPES" not in text, text


def test_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_texts_that_share_a_doc_id(spark):
    """Each text is linked by itself, whatever other texts its doc_id has; of each group one row stays."""
    words = lambda k, n=60: " ".join(f"w{k}x{i}" for i in range(n))
    near = words(5).split(" ")
    near[30] = "other"
    rows = [(1, words(1)), (1, words(2)), (2, words(1)), (3, words(2)), (0, words(3)), (1, words(3)), (4, words(4)), (4, words(4)), (7, words(5)), (7, " ".join(near)), (8, words(5)),
            (9, ""), (9, None), (9, " "), (None, words(1))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, text_key string")
    found = Counter(map(tuple, minhash.near_duplicates(docs, 5).select("doc_id", "component_id", "kept").collect()))
    assert found == Counter([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (0, 0, True), (1, 0, False), (4, 4, True), (4, 4, True), (7, 7, True), (7, 7, True), (8, 7, False),
                             (9, 9, True), (9, 9, True), (9, 9, True), (None, None, None)])
    kept = Counter((r["doc_id"], r["text"]) for r in minhash.one_of_each(docs, 5).collect())
    assert {k: n for k, n in kept.items() if k[0] not in (7, 9)} == {(1, words(1)): 1, (1, words(2)): 1, (0, words(3)): 1, (4, words(4)): 1, (None, words(1)): 1}
    assert sum(n for k, n in kept.items() if k[0] == 7) == 1 and sum(n for k, n in kept.items() if k[0] == 9) == 2
