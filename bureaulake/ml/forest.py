"""Isolation forest (Liu, Ting and Zhou, 2008): trees grown in parallel, scoring vectorised per batch.

A tree needs a fixed small sample whatever the table size, so each tree is one small group; the whole forest
has at most ``trees * 2 * sample`` nodes, which bounds what is broadcast to the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureaulake import catalog

NODE = "tree int, node int, feature int, threshold double, left int, right int, size int"


def samples(vectors: DataFrame, total: int, trees: int, sample: int, seed: int) -> DataFrame:
    """About ``sample`` rows per tree plus a margin, drawn by hash in one pass: ``tree, draw, values``."""
    share = min(1.0, (sample + 8.0 * sample ** 0.5 + 10.0) / max(total, 1))

    def draw(tree):
        return F.pmod(F.xxhash64("request_id", tree, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < share)
    values = F.array(*[F.coalesce(f, F.lit(0.0)) for f in catalog.FEATURES])
    rows = vectors.select("request_id", values.alias("values"), F.explode(drawn).alias("tree"))
    return rows.select("tree", draw(F.col("tree")).alias("draw"), "values")


def grow(frame: pd.DataFrame, sample: int, seed: int) -> pd.DataFrame:
    """One isolation tree over the ``sample`` lowest draws of its group."""
    tree = int(frame["tree"].iloc[0])
    data = np.array(frame.sort_values("draw").head(sample)["values"].tolist(), dtype=float)
    random = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(data), 2))))
    nodes: list[tuple] = []

    def split(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append(None)
        spread = rows.max(axis=0) - rows.min(axis=0)
        usable = np.flatnonzero(spread > 0)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes[me] = (tree, me, -1, 0.0, -1, -1, len(rows))
            return me
        feature = int(random.choice(usable))
        low = rows[:, feature].min()
        threshold = float(low + random.random() * spread[feature])
        goes_left = rows[:, feature] <= threshold
        left = split(rows[goes_left], depth + 1)
        right = split(rows[~goes_left], depth + 1)
        nodes[me] = (tree, me, feature, threshold, left, right, len(rows))
        return me

    split(data, 0)
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])


def fit(vectors: DataFrame, trees: int = 200, sample: int = 256, seed: int = 42) -> DataFrame:
    """Node table of the forest."""
    total = vectors.count()
    drawn = samples(vectors, total, trees, sample, seed)
    return drawn.groupBy("tree").applyInPandas(lambda frame: grow(frame, sample, seed), NODE)


def average_path(n):
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    big = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def pack(nodes: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """The bounded node table as arrays per tree."""
    frame = nodes.toPandas().sort_values(["tree", "node"])
    return {int(t): {c: g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size")} for t, g in frame.groupby("tree")}


def anomaly(values: np.ndarray, forest: dict, sample: int) -> np.ndarray:
    """Score per row, lower for more unusual rows: ``-2 ** (-mean depth / expected depth)``."""
    depth = np.zeros(len(values))
    for arrays in forest.values():
        at = np.zeros(len(values), dtype=int)
        steps = np.zeros(len(values))
        active = arrays["feature"][at] >= 0
        while active.any():
            here = at[active]
            goes_left = values[active, arrays["feature"][here]] <= arrays["threshold"][here]
            at[active] = np.where(goes_left, arrays["left"][here], arrays["right"][here])
            steps[active] += 1
            active = arrays["feature"][at] >= 0
        depth += steps + average_path(arrays["size"][at])
    return -np.power(2.0, -(depth / len(forest)) / float(average_path(sample)))


def score(vectors: DataFrame, nodes: DataFrame, sample: int = 256) -> DataFrame:
    """``request_id, anomaly_raw`` for the whole table."""
    shared = vectors.sparkSession.sparkContext.broadcast(pack(nodes))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                values = np.array(frame["values"].tolist(), dtype=float)
                yield pd.DataFrame({"request_id": frame["request_id"], "anomaly_raw": anomaly(values, shared.value, sample)})

    rows = vectors.select("request_id", F.array(*[F.coalesce(f, F.lit(0.0)) for f in catalog.FEATURES]).alias("values"))
    return rows.mapInPandas(batches, "request_id string, anomaly_raw double")
