"""Exact ranks over very large groups.

A plain ``row_number`` puts a whole group into one task.  Here a group is cut into buckets that are
monotone in the order: rows are numbered inside a bucket, and each bucket gets the number of rows before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.sources import scratch

HASH_PREFIX = 4  # 65 536 buckets for an evenly spread hash
BUCKETS = 256


def row_number_in_buckets(df: DataFrame, keys: list[str], bucket: Column, order: list[Column],
                          name: str = "row_number") -> DataFrame:
    """Adds a 1-based exact row number per ``keys``; ``bucket`` must not decrease along ``order``.

    Only the bucket counts are ordered per group, and there are as many of those as buckets.
    """
    bucketed = df.withColumn("_bucket", bucket)
    counts = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[F.col(k) for k in keys], F.lit(0)).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside))
    return numbered.join(starts, [*keys, "_bucket"]).withColumn(
        name, F.col("_start") + F.col("_inside")).drop("_bucket", "_start", "_inside")


def hash_bucket(digest: Column) -> Column:
    return F.substring(digest, 1, HASH_PREFIX)


def split_labels(df: DataFrame, stratum: list[str], digest: Column, train: float = 0.70,
                 validation: float = 0.15) -> DataFrame:
    """Adds ``split``: shares per stratum, exact to the row, reproducible from the id alone.

    ``floor(n * share)`` rows in digest order go to training, the next share to validation, the rest to holdout.
    """
    hashed = df.withColumn("_digest", digest)
    ranked = row_number_in_buckets(hashed, stratum, hash_bucket(F.col("_digest")), [F.col("_digest")], "_rank")
    sizes = hashed.groupBy(*stratum).agg(F.count(F.lit(1)).alias("_size"))
    joined = ranked.join(sizes, stratum) if stratum else ranked.crossJoin(F.broadcast(sizes))
    first, second = F.floor(F.col("_size") * train), F.floor(F.col("_size") * (train + validation))
    return joined.withColumn("split", F.when(F.col("_rank") <= first, F.lit("train"))
                             .when(F.col("_rank") <= second, F.lit("validation")).otherwise("holdout")
                             ).drop("_digest", "_rank", "_size")


def hash_sample(df: DataFrame, digest: Column, size: int) -> DataFrame:
    """The ``size`` rows with the smallest digests, or all rows if there are fewer; every task keeps at most ``size``."""
    return df.withColumn("_digest", digest).orderBy("_digest").limit(size).drop("_digest")


def with_value_bucket(df: DataFrame, keys: list[str], value: str, name: str = "_b", buckets: int = BUCKETS) -> DataFrame:
    """Adds a bucket number that doesn't decrease along ``value``.

    Split points are approximate quantiles of the rows at hand, so that buckets have about as many rows each, however
    values are spread; equal values share a bucket. There is one row of split points per key.
    """
    shares = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    splits = df.groupBy(*keys).agg(F.percentile_approx(value, shares, 20 * buckets).alias("_splits"))
    joined = df.join(splits, keys) if keys else df.crossJoin(F.broadcast(splits))  # one row
    return joined.withColumn(name, F.size(F.filter("_splits", lambda s: s < F.col(value)))).drop("_splits")


def row_numbers(df: DataFrame, keys: list[str], order: str, name: str = "row_number", most: int = 1_000_000) -> DataFrame:
    """Adds a 1-based exact row number per ``keys`` along a numeric column.

    Keys with up to ``most`` rows are ordered whole: there may be any number of them and they cost one shuffle. Only the others, of
    which there are at most all rows divided by ``most``, get split points. Null keys count as equal.
    """
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    plain = df.join(heavy, same, "left_anti").withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("long"))
    hot = df.join(heavy, same, "left_semi")
    hot = row_number_in_buckets(with_value_bucket(hot, keys, order, "_part"), keys, F.col("_part"), [F.col(order)], name)
    return plain.unionByName(hot.select(*plain.columns))


def value_counts(df: DataFrame, keys: list[str], name: str = "value-counts") -> DataFrame:
    """How often each value that isn't null occurs per ``keys``, as ``value, _n``; stored, since quantiles read it several times."""
    return scratch.written(df.filter("value is not null").groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n")), name)


def quantiles(df: DataFrame, keys: list[str], shares: list[float], buckets: int = BUCKETS) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per ``keys``: one row per key and ``share``."""
    return quantiles_of_counts(value_counts(df, keys), keys, shares, buckets)


def quantiles_of_counts(counts: DataFrame, keys: list[str], shares: list[float], buckets: int = BUCKETS) -> DataFrame:
    """The same from :func:`value_counts`.

    No task holds all values.  Buckets between split points of the values give the rows before each bucket, and only the buckets
    that hold a wanted rank are ordered.
    """
    span = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    spread = with_value_bucket(counts, keys, "value", "_b", buckets)

    # Bucket totals: at most ``buckets`` rows per key.
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = spread.groupBy(*keys, "_b").agg(F.sum("_n").alias("_m")).withColumn("_start", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    position = (F.col("_total") - 1) * F.col("share")
    ranks = span.select(*keys, "_total", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")).select(
        *keys, "share", position.alias("_h"), F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("_rank"))
    wanted = ranks.join(starts, keys).filter(F.col("_rank").between(F.col("_start"), F.col("_start") + F.col("_m") - 1))

    inside = Window.partitionBy(*keys, "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ordered = spread.join(wanted.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi").withColumn(
        "_below", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    inner = F.col("_rank") - F.col("_start")
    found = wanted.join(ordered, [*keys, "_b"]).filter(inner.between(F.col("_below"), F.col("_below") + F.col("_n") - 1))
    part = F.max("_h") - F.floor(F.max("_h"))
    return found.groupBy(*keys, "share").agg(
        (F.min("value") + (F.max("value") - F.min("value")) * part).alias("quantile"))
