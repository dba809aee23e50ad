"""Frequent phrases and how strongly their parts belong together, by mergeable Misra-Gries summaries and an exact second pass.

First pass: the phrases of one to ``longest`` words of a run of documents are counted and dealt out by hash partition. A partition's
counts come together in a summary whose capacity exceeds its mass divided by the threshold. Whenever there are more phrases than
that, all counts are lowered by the next largest one. Each lowering by one takes more than ``capacity`` occurrences away, so the
counts are lowered by less than the threshold altogether, and a phrase as frequent as the threshold can't get lost: its count
plus what was lowered is at least its true number. Here a 36-bit number within the partition stands for a phrase. Two phrases of one
number only make it look more frequent. A run's own counts are never lowered: the runs share one threshold, so there is nothing to
lower in a small one.

Second pass: each run of documents gets back the numbers that survived among its own and counts these phrases exactly, by their
words. Counts of phrases that only looked frequent are below the threshold and go.

All counts are per language; null is ``und``. Null and empty texts have no words. Repeated rows count as often as they occur.
Phrases are told apart by their bytes. A text of any length is cut into words whole; its phrases are counted where it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.llm import spans, tokens
from bureaulake.llm.blocks import gathered, pack, spread, unpack
from bureaulake.llm.common import give_back, groups_of, partitions, prepare, stored

#: Bits of a phrase's number within its partition, and bytes of text counted at once.
BITS, PIECE = 36, 1 << 20
#: Rows of counted phrases that a task holds before it adds up equal ones.
SOME = 400_000
#: Bytes of text of a run of documents, and of all texts for each partition. Every run has a row for every partition, so both should
#: grow with the memory of a task where there is much text.
RUN, PART = 8 << 20, 16 << 20
NO_LANGUAGE = "und"
#: Parts of a language that are ranked apart before all.
PARTS = 64
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [*range(10, 14)]] = True
APART = BREAK.copy()
APART[[32, 9]] = True
#: ``mass`` is the number of occurrences in a run's summary of a partition, and -1 for a piece of text.
ROWS = "run long, bucket int, mass long, payload binary"


# ---- phrases of texts


class Phrases:
    """Words of some texts and all runs of them that may be phrases: within one text and without a break between them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data = tokens.LOWER[data]
        edge = tokens.edges_of(len(data), offsets)
        apart = np.concatenate([[True], APART[data], [True]])
        inside = ~apart[1:-1]
        self.starts = np.flatnonzero(inside & (apart[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(inside & (apart[2:] | edge[1:])) + 1
        owner = np.searchsorted(offsets, self.starts, "right") - 1
        self.lang, names = pd.factorize(np.array(langs, object)) if langs else (np.zeros(0, np.int64), [])
        self.names = list(names)
        self.lang = self.lang[owner]
        breaks = np.concatenate([[0], np.cumsum(BREAK[data])])
        self.hashes = tokens.span_hashes(self.data, self.starts, self.ends)
        self.linked = np.zeros(len(self.starts), bool)  # to the word before
        self.linked[1:] = (owner[1:] == owner[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1]])

    def each_size(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, the first words of all phrases of the size, their hashes with the language)."""
        seeds = np.array([xxhash.xxh3_64_intdigest(name.encode()) for name in self.names], np.uint64)
        at = np.arange(len(self.starts))
        h = tokens.mix(seeds[self.lang] ^ self.hashes) if len(at) else np.zeros(0, np.uint64)
        yield 1, at, h
        for size in range(2, longest + 1):
            go = at + size - 1 < len(self.starts)
            at, h = at[go], h[go]
            go = self.linked[at + size - 1]
            at, h = at[go], h[go]
            h = tokens.mix(h * np.uint64(0xD1342543DE82EF95) + self.hashes[at + size - 1])
            yield size, at, h

    def counts(self, longest: int, kept: np.ndarray, buckets: int) -> pa.Table:
        """lang, size, phrase and exact number of the phrases whose place is among the sorted ``kept``; and all words under size 0."""
        codes, first = spans.distinct(self.data, self.starts, self.ends, self.hashes)
        words = pa.array(spans.values(self.data, self.starts[first], self.ends[first]), pa.binary()).cast(pa.string())
        names = pa.array(self.names, pa.string())
        totals = np.bincount(self.lang, minlength=len(self.names))
        out = [_rows(names, 0, pa.array([""] * len(self.names), pa.string()), totals)]
        for size, at, h in self.each_size(longest):
            place = places(h, buckets)
            where = np.searchsorted(kept, place)
            hit = where < len(kept)
            hit[hit] = kept[where[hit]] == place[hit]
            at = at[hit]
            key = self.lang[at].astype(np.int64)
            for k in range(size):  # numbers of equal phrases, exactly
                key, _ = pd.factorize(key * (len(first) + 1) + codes[at + k])
            if not len(at):
                continue
            model = at[np.flatnonzero(key > np.maximum.accumulate(np.append(-1, key[:-1])))]
            text = [words.take(pa.array(codes[model + k])) for k in range(size)]
            phrase = pc.binary_join_element_wise(*text, " ") if size > 1 else text[0]
            out.append(_rows(names.take(pa.array(self.lang[model])), size, phrase, np.bincount(key)))
        return pa.concat_tables(out)


def _rows(lang: pa.Array, size: int, phrase: pa.Array, f: np.ndarray) -> pa.Table:
    return pa.table({"lang": lang, "size": pa.array(np.full(len(f), size, np.int32)), "phrase": phrase, "f": pa.array(f.astype(np.int64))})


def places(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Partition and number within it, as one number."""
    low = hashes & np.uint64((1 << BITS) - 1)
    return ((hashes >> np.uint64(BITS)) % np.uint64(buckets)).astype(np.int64) << BITS | low.astype(np.int64)


# ---- packed numbers


def packed(numbers: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Sorted numbers as bytes of their differences, and counts."""
    gaps = np.diff(numbers, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    return pack([np.ascontiguousarray(gaps[:, k]) for k in range(BITS // 8 + 1)], None if counts is None else spread(counts))


def unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    planes, counts = unpack(payload)
    gaps = np.zeros((len(planes[0]), 8), np.uint8)
    for k, plane in enumerate(planes):
        gaps[:, k] = plane
    return np.cumsum(gaps.view("<u8").ravel().astype(np.int64)), None if counts is None else gathered(counts)


# ---- first pass


def _cut(longest: int, buckets: int, run_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of documents: one row for each partition with its counted phrases, and one for each piece of text, dealt to any partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for table in groups_of(batches, "text", run_bytes):
            texts, found = [], []
            langs = table.column("lang").to_pylist()
            for i, j, data, offsets in tokens.chunks(table.column("text"), PIECE):
                texts.append(pack(data, offsets, langs[i:j]))
                place, often = np.unique(np.concatenate([places(h, buckets) for _, _, h in Phrases(data, offsets, langs[i:j]).each_size(longest)]), return_counts=True)
                found.append((place, often.astype(np.int32), np.searchsorted(place, np.arange(buckets + 1, dtype=np.int64) << BITS)))
            ours = (part << 24) + number
            rows: tuple[list, ...] = ([ours] * len(texts), [(ours + k) % buckets for k in range(len(texts))], [-1] * len(texts), texts)
            for b in range(buckets):
                place, often = summed([(p[at[b] : at[b + 1]], n[at[b] : at[b + 1]]) for p, n, at in found])
                if len(place):
                    for column, value in zip(rows, (ours, b, int(often.sum()), packed(place & ((1 << BITS) - 1), often)), strict=True):
                        column.append(value)
            del table, found, texts
            yield from _batches(rows)
            del rows
            give_back()
            number += 1

    return run


def _batches(rows: tuple[list, ...], size: int = 64) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    for i in range(0, len(rows[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + size], t) for c, t in zip(rows, kinds, strict=True)], names=["run", "bucket", "mass", "payload"])


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers and the sums of their counts."""
    numbers, counts = (np.concatenate(x).astype(np.int64, copy=False) for x in zip(*parts, strict=True))
    by = np.argsort(numbers, kind="stable")
    numbers, counts = numbers[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])[: len(numbers)])
    return numbers[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary of sorted numbers: counts, and by how much they have been lowered."""

    def __init__(self, capacity: int):
        self.capacity, self.lowered = capacity, 0
        self.numbers, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, others: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Takes in the numbers and counts of other summaries that were never lowered."""
        self.numbers, self.counts = summed([(self.numbers, self.counts), *others])
        if len(self.numbers) > self.capacity:
            low = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            stay = self.counts > low
            self.numbers, self.counts = self.numbers[stay], self.counts[stay] - low
            self.lowered += int(low)

    def at_least(self, threshold: int) -> np.ndarray:
        """The numbers whose true count may reach the threshold."""
        return self.numbers[self.counts + self.lowered >= threshold]


def _survivors(threshold: int) -> Callable[[pa.Table], pa.Table]:
    """One partition's summary, and which of each run's numbers survive in it; pieces of text go through."""

    def run(group: pa.Table) -> pa.Table:
        mass = group.column("mass")
        texts, group = group.filter(pc.less(mass, 0)), group.filter(pc.greater_equal(mass, 0))
        summary = Summary((pc.sum(group.column("mass")).as_py() or 0) // threshold + 1)
        payloads = group.column("payload")
        held, size = [], 0
        for payload in payloads:
            held.append(unpacked(payload.as_py()))
            size += len(held[-1][0])
            if size > summary.capacity:
                summary.merge(held)
                held, size = [], 0
        summary.merge(held)
        kept = summary.at_least(threshold)
        del summary, held
        give_back()
        out, runs, buckets = [], [], []
        for ours, bucket, payload in zip(group.column("run").to_pylist(), group.column("bucket").to_pylist(), payloads, strict=True):
            numbers, _ = unpacked(payload.as_py())
            where = np.searchsorted(kept, numbers)
            hit = where < len(kept)
            hit[hit] = kept[where[hit]] == numbers[hit]
            if hit.any():
                runs.append(ours)
                buckets.append(bucket)
                out.append(packed(numbers[hit]))
        answers = pa.table({"run": pa.array(runs, pa.int64()), "bucket": pa.array(buckets, pa.int32()),
                            "mass": pa.array([0] * len(out), pa.int64()), "payload": pa.array(out, pa.binary())})
        return pa.concat_tables([answers, texts.cast(answers.schema)])

    return run


# ---- second pass


def _exact(longest: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Counts of the surviving phrases in one run's texts."""

    def run(group: pa.Table) -> pa.Table:
        texts, kept = [], []
        for bucket, mass, payload in zip(group.column("bucket").to_pylist(), group.column("mass").to_pylist(), group.column("payload"), strict=True):
            if mass < 0:
                texts.append(payload)
            else:
                kept.append(unpacked(payload.as_py())[0] + (bucket << BITS))
        places_kept = np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
        del kept
        total, found, size = None, [], 0  # each run has at least one piece of text
        for k, text in enumerate(texts, 1):
            found.append(Phrases(*unpack(text.as_py())).counts(longest, places_kept, buckets))
            size += len(found[-1])
            if size > SOME or k == len(texts):  # equal phrases of some pieces become one before there are more
                total = _added([*([] if total is None else [total]), *found])
                found, size = [], 0
        give_back()
        return total

    return run


def _added(found: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(found).group_by(["lang", "size", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return pa.table([total.column(c) for c in ("lang", "size", "phrase", "f_sum")], names=["lang", "size", "phrase", "f"])


def frequent(docs: DataFrame, threshold: int = 10, longest: int = 3, run_bytes: int = RUN, part_bytes: int = PART) -> DataFrame:
    """lang, size, phrase, f: every phrase of 1 to ``longest`` words that a language has at least ``threshold`` times, and how often.

    One more row for each language, with size 0, has the number of its words.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(16, 2 * partitions(spark), size // part_bytes)
    cut = docs.mapInArrow(_cut(longest, buckets, run_bytes), ROWS)
    answers = cut.groupBy("bucket").applyInArrow(_survivors(threshold), ROWS)
    counts = answers.groupBy("run").applyInArrow(_exact(longest, buckets), "lang string, size int, phrase string, f long")
    return counts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("size") == 0) | (F.col("f") >= threshold))


# ---- scores


def collocations(docs: DataFrame, threshold: int = 10, longest: int = 3, top: int = 2000, inside: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each language.

    A cut into two parts has the score floor(1 000 000 a a / (l r)); a phrase has that of its weakest cut, the first of equal ones.
    A phrase goes if a longer one that holds its words has ``inside`` percent of its occurrences or more. Ties between phrases go by
    count and then by their bytes.
    """
    counts = stored(frequent(docs, threshold, longest), "phrases")
    parts = counts.where("size > 0").select("lang", "phrase", "f")
    candidates = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = {c: f"CAST({c} AS DECIMAL(19,0))" for c in ("a", "l", "r")}
    score = F.expr(f"({wide['a']} * {wide['a']} * 1000000BD) div ({wide['l']} * {wide['r']})")
    scored = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    held = candidates.where("size > 2").select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("short"))
    held = held.select("lang", "a", "words", "short", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("short") + 1)).alias("at")).select(
        "lang", F.array_join(F.slice("words", F.col("at"), F.col("short")), " ").alias("phrase"), F.col("a").alias("longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    stays = scored.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    order = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    # the best of each of some parts of a language first, so that the last step sees a bounded number of them, however many tasks there are
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = stays.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                                              "n", F.col("cut.score").cast("long").alias("score"))


def oracle(threshold: int = 10, top: int = 2000, inside: int = 50) -> str:
    """The same for phrases of 2 and 3 words as SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM listed
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM listed WHERE len(w) > 2),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= {threshold}),
cuts AS (
  SELECT lang, size, phrase, a, w, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, size, phrase, a, w, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE size = 3) GROUP BY ALL),
stays AS (SELECT s.* FROM weakest s LEFT JOIN longer h ON h.lang = s.lang AND h.phrase = s.phrase WHERE h.longer IS NULL OR 100 * h.longer < {inside} * s.a)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM stays s JOIN totals t ON t.lang = s.lang
QUALIFY rank <= {top}
"""
