"""Near-duplicates by b-bit MinHash.

Texts are sets of word shingles. Texts with the same set are one class, of which the smallest doc_id stands for all. Classes
that share a band of minima are candidates; the packed low bits of all minima estimate their similarity, corrected for chance
collisions; pairs whose estimate could still reach the threshold are confirmed on the full sets.

Within a bucket every class is first compared only with the bucket's centre, the class that shares most buckets with others.
Components of the confirmed links are formed, and only members of a bucket that are still in different components are compared
with each other, inside tiles of bounded size: first each is confirmed against those of each other component that it looks
closest to, then against all that are left. So a group of copies of any size costs few pairs, all pairs of a group never leave
a task, and no candidate is dropped unseen.

Null texts and texts without words have the empty set: n_shingles 0, in a component of their own. Texts with fewer words than
a shingle have the whole sequence as one. Rows with the same doc_id and text get the same result. Rows that share a doc_id but not
the set are different members: each is linked by its own text, and kept if the smallest doc_id reachable is its own. Null ids stay
null and are linked with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.llm import tokens
from bureaulake.llm.common import components, prepare, runs, stored

#: Bands, minima per band, all minima, low bits kept of each. At similarity 0.8 a pair shares no band with probability 1.3e-7.
BANDS, ROWS, HASHES, BITS = 40, 5, 640, 4
LANES = 64 // BITS
#: Standard errors by which an estimate may miss the threshold before a candidate is let go.
SLACK = 5.0
#: Classes of a bucket on one side of a tile, and partners in another component that are confirmed before all others.
TILE, CLOSEST = 4096, 4

_rng = np.random.default_rng(90210)
_A = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = tokens.LOWER[data]
    starts, ends, first = tokens.word_spans(data, offsets)
    hashes = tokens.span_hashes(data, starts, ends)
    grams, at = tokens.windows(hashes, first, size)
    bounds = np.searchsorted(at, first)
    out = []
    for i in range(len(offsets) - 1):
        n = first[i + 1] - first[i]
        if n >= size:
            out.append(np.unique(grams[bounds[i] : bounds[i + 1]]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for h in hashes[first[i] : first[i + 1]]:
                whole = whole * np.uint64(0xD1342543DE82EF95) + h
            out.append(tokens.mix(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(hashes: np.ndarray, step: int = 512) -> np.ndarray:
    low = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    best = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), step):
        best = np.minimum(best, (low[i : i + step, None] * _A + _B).min(0))
    return best


def packed(best: np.ndarray) -> np.ndarray:
    """The low BITS of each minimum, LANES of them in each 64-bit number."""
    low = np.zeros(-(-len(best) // LANES) * LANES, np.uint64)
    low[: len(best)] = best & np.uint32((1 << BITS) - 1)
    shift = np.uint64(BITS) * np.arange(LANES, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(-1, LANES) << shift, axis=1).view(np.int64)


def _sign(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, bits, bands = [], [], [], []
            for _, _, data, offsets in tokens.chunks(batch.column("text")):
                for found in shingle_sets(data, offsets, size):
                    n.append(len(found))
                    if len(found):
                        best = minima(found)
                        band = tokens.windows(best[: BANDS * ROWS].astype(np.uint64), np.arange(0, BANDS * ROWS + 1, ROWS), ROWS)[0]
                        keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                        bits.append(packed(best))
                        bands.append(band.view(np.int64))
                    else:
                        keys.append(None)
                        bits.append(None)
                        bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                                             names=["doc_id", "text_key", "n_shingles", "set_key", "bits", "bands"])

    return run


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for _, _, data, offsets in tokens.chunks(batch.column("text")) for s in shingle_sets(data, offsets, size)]
            ids, keys = batch.column("id").to_pylist(), batch.column("set_key").to_pylist()
            own = [k for k, s in enumerate(found) if xxhash.xxh3_128_digest(s.tobytes()) == keys[k]]  # not another text of the same doc_id
            yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in own], pa.int64()), pa.array([found[k].view(np.int64) for k in own], pa.list_(pa.int64()))],
                                             names=["id", "shingles"])

    return run


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures: equal lanes are counted by bits, and chance agreement is taken off."""
    words = -(-HASHES // LANES)
    ones = int.from_bytes(bytes([0x11] * 8), "big") if BITS == 4 else sum(1 << (BITS * k) for k in range(LANES))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    unlike = F.lit(0)
    for w in range(words):
        x = F.get(F.col(a), w).bitwiseXOR(F.get(F.col(b), w))
        for k in (1, 2):  # folds each lane of four bits onto its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        unlike = unlike + F.bit_count(x.bitwiseAND(F.lit(ones)))
    like = 1 - unlike / F.lit(HASHES)
    chance = 2.0**-BITS
    return (like - chance) / (1 - chance)


def lowest_estimate(threshold: float) -> float:
    chance = 2.0**-BITS
    p = threshold + (1 - threshold) * chance
    return threshold - SLACK * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


ONES = np.uint64(sum(1 << (BITS * k) for k in range(LANES)))


def _alike(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = bits[a] ^ bits[b]
    for k in (1, 2):
        x |= x >> np.uint64(k)
    unlike = np.bitwise_count(x & ONES).sum(1)
    chance = 2.0**-BITS
    return (1 - unlike / HASHES - chance) / (1 - chance)


def _apart(least: float, threshold: float, closest: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of a tile that are in different components, agree on no earlier band and may be similar enough.

    With ``closest``, of each member and each other component only so many of the likeliest.
    """

    def found(rows: dict[str, list], tile: tuple) -> np.ndarray:
        band, _, first, second = tile
        ids, half = np.array(rows["id"]), np.array(rows["half"])
        _, root = np.unique(np.array(rows["root"]), return_inverse=True)
        main = np.bincount(root).argmax()
        bits = np.array(rows["bits"], np.int64).view(np.uint64)
        bands = np.array(rows["bands"], np.int64)
        n = np.array(rows["n_shingles"])
        kept = []
        for i in np.flatnonzero(root != main):
            other = root != root[i]
            if first != second:
                other &= half != half[i]
            other &= (root == main) | (ids < ids[i])
            j = np.flatnonzero(other)
            j = j[np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i])]  # no set that is much smaller can be similar
            if band:
                j = j[~(bands[j, :band] == bands[i, :band]).any(1)]
            like = _alike(bits, np.full(len(j), i), j)
            j, like = j[like >= least], like[like >= least]
            if closest is not None and len(j):
                order = np.lexsort((-like, root[j]))
                place = np.arange(len(j)) - np.searchsorted(root[j][order], root[j][order], "left")
                j = j[order[place < closest]]
            kept.append(np.stack([np.maximum(ids[i], ids[j]), np.minimum(ids[i], ids[j])]))
        return np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, rows in runs(batches, ["band", "key", "first", "second"], ["id", "root", "half", "n_shingles", "bits", "bands"]):
            pairs = found(rows, tile)
            if pairs.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


#: Classes that share their smallest doc_id with another one get a number below this instead, so that a number means one class.
APART = -(1 << 62)


def _placed(docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, component_id and root for each row of (doc_id, text); components with one root are one."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key"), "text")
    signed = stored(texts.mapInArrow(_sign(size), "doc_id long, text_key string, n_shingles long, set_key binary, bits array<long>, bands array<long>"), "signatures")
    signed = signed.withColumn("set_key", F.when(F.col("doc_id").isNotNull(), F.col("set_key")))
    # copies of a set are one class; equal sets have equal signatures
    classes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("low"))
    clash = F.row_number().over(Window.partitionBy("low").orderBy("set_key")) > 1
    classes = stored(classes.withColumn("id", F.when(clash, F.lit(APART) - F.shiftrightunsigned(F.xxhash64("set_key"), 2)).otherwise(F.col("low"))), "classes")
    own = classes.select(F.col("low").alias("doc_id"), "set_key", "id")
    heads = stored(signed.join(own, ["doc_id", "set_key"]).select("id", "n_shingles", "bits", "bands").dropDuplicates(["id"]), "heads")
    buckets = heads.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = buckets.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(buckets.join(sizes, ["band", "key"]), "buckets")  # (band, key, id, n) of buckets with company
    company = shared.groupBy("id").agg(F.sum("n").alias("company"))
    centres = shared.join(company, "id").groupBy("band", "key").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("top")).select(
        "band", "key", (-F.col("top.minus")).alias("top"))
    least = lowest_estimate(threshold)
    bits = heads.select("id", "bits", F.col("n_shingles").alias("n"))
    wanted = texts.join(own.join(company.select("id"), "id", "left_semi"), "doc_id").select("id", "set_key", "text_key", "text").dropDuplicates(["id", "text_key"])
    sets = stored(wanted.select("id", "set_key", "text").mapInArrow(_sets(size), "id long, shingles array<long>").dropDuplicates(["id"]), "sets")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with their estimate, where it can still reach the threshold."""
        both = pairs
        for c in "ab":
            both = both.join(bits.withColumnsRenamed({"id": c, "bits": f"bits_{c}", "n": f"n_{c}"}), c)
        both = both.where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))  # no set that is much smaller can be similar
        return both.withColumn("like", estimate("bits_a", "bits_b")).where(F.col("like") >= least).drop("bits_a", "bits_b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (a, b), on the full sets."""
        both = pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "set_a"}), "a").join(sets.withColumnsRenamed({"id": "b", "shingles": "set_b"}), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        return both.where(100 * common >= round(100 * threshold) * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")

    stars = shared.join(centres, ["band", "key"]).where("id != top").select(F.greatest("id", "top").alias("a"), F.least("id", "top").alias("b"), "id").distinct()
    pairs = stored(likely(stars).select("a", "b", "id", "like"), "stars")
    # of a class's stars the likeliest goes first; most others then lie within a component already
    first = stored(pairs.groupBy("id").agg(F.max(F.struct("like", "a", "b")).alias("best")).select("best.a", "best.b").distinct(), "first")
    roots = components(confirmed(first), "a", "b")
    tested = first

    def grown(roots: DataFrame, links: DataFrame) -> DataFrame:
        """Components after more links; those there are stand for the links they came from."""
        return components(roots.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links), "a", "b")

    def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        own = lambda c: F.coalesce(F.col(f"root_{c}"), F.col(c))
        both = pairs
        for c in "ab":
            both = both.join(roots.withColumnsRenamed({"node": c, "component": f"root_{c}"}), c, "left")
        return both.withColumns({"root_a": own("a"), "root_b": own("b")}).where("root_a != root_b")

    rest = stored(apart(pairs.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), roots).select("a", "b"), "rest")
    if not rest.isEmpty():
        roots = grown(roots, confirmed(rest))
        tested = tested.unionAll(rest)
    tile = ["band", "key", "first", "second"]
    cut = F.ceil(F.col("n") / TILE).cast("int")
    for closest in (CLOSEST, None):
        placed = shared.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("component", "id")).drop("component")
        mixed = placed.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        members = placed.join(mixed.select("band", "key"), ["band", "key"], "left_semi").join(heads.select("id", "n_shingles", "bits", "bands"), "id")
        tiled = members.withColumns({"half": F.pmod(F.xxhash64("id"), cut).cast("int"), "other": F.explode(F.sequence(F.lit(0), cut - 1))}).select(
            "band", "key", F.least("half", "other").alias("first"), F.greatest("half", "other").alias("second"), "half", "id", "root", "n_shingles", "bits", "bands")
        new = tiled.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_apart(least, threshold, closest), "a long, b long").distinct()
        new = stored(new.join(tested, ["a", "b"], "left_anti"), "apart")
        if not new.isEmpty():
            roots = grown(roots, confirmed(new))
            tested = tested.unionAll(new)
    found = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").select("set_key", "low", F.coalesce("component", "id").alias("root"))
    lowest = found.where(F.col("root") <= APART).groupBy("root").agg(F.min("low").alias("lowest"))  # only where doc_ids clash
    found = found.join(lowest, "root", "left").select("set_key", "root", F.coalesce("lowest", "root").alias("component_id"))
    linked = signed.where("set_key is not null").join(found, "set_key")
    alone = signed.where("set_key is null").withColumns({"root": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    columns = ["doc_id", "text_key", "n_shingles", "set_key", "component_id", "root"]
    return linked.select(*columns).unionAll(alone.select(*columns))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of (doc_id, text)."""
    return _placed(docs, size, threshold).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest doc_id, and of equal ones of the smallest
    digest of the text. Rows without doc_id stay; of texts without words those that differ in doc_id or text do."""
    placed = _placed(docs, size, threshold)
    groups = placed.where("root is not null and doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select("first.*")
    kept = groups.unionAll(placed.where("root is null and doc_id is not null").select("doc_id", "text_key")).distinct()
    known = docs.where("doc_id is not null").withColumns({"_kept_id": F.col("doc_id").cast("long"), "_text_key": F.md5(F.coalesce("text", F.lit("")).cast("binary"))})
    rows = known.join(kept, (F.col("_kept_id") == kept["doc_id"]) & (F.col("_text_key") == kept["text_key"]), "left_semi")
    return rows.dropDuplicates(["_kept_id", "_text_key"]).drop("_kept_id", "_text_key").unionAll(docs.where("doc_id is null"))
