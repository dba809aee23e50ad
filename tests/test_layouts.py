"""Streams over folders of parts and over nothing; ranks on skewed values."""

from __future__ import annotations

import pytest
from compare import compare
from pyspark.sql import functions as F

from bureaulake import queries as registry
from bureaulake.operators import batches, metrics, ranking
from bureaulake.streaming import jobs

STREAMS = ["stream_requests", "stream_fanout", "stream_batch_progress", "stream_training_done", "stream_daily", "run_state"]


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    """The tables as folders of several parts."""
    folder = tmp_path_factory.mktemp("parts")
    for name in ("events", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("key", STREAMS)
def test_stream_over_folder(spark, duck, parts, key):
    text, _, _ = compare(spark, duck, key, registry.queries()[key], registry.oracle_sql()[key], parts)
    assert text.startswith("ok"), text


def test_stream_over_nothing(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert registry.queries()["stream_requests"](spark, str(tmp_path)).count() == 0
    assert registry.queries()["stream_daily"](spark, str(tmp_path)).count() == 0


def test_late_rows_go_aside(spark):
    rows = [(1, 0, "2024-01-05"), (2, 0, "2024-01-06"), (2, 0, "2024-01-06"), (3, 1, "2024-01-01"), (4, 1, "2024-01-07"), (5, 1, "2024-01-05")]
    table = spark.createDataFrame(rows, "id long, batch int, day string").withColumn("at", F.col("day").cast("timestamp")).drop("day")
    out = jobs.run(jobs.staged(table, F.col("batch"), 2, "t"), jobs.late_sink(["id"], "at", 2 * 86_400_000), "append", "late")
    ids = {kind: sorted(r["id"] for r in spark.read.parquet(f"{out}/{kind}").collect()) for kind in ("rows", "late")}
    assert ids == {"rows": [1, 2, 4, 5], "late": [3]}


def test_buckets_follow_the_values(spark):
    """One extreme value doesn't put all others into one bucket."""
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") / 7).alias("value"), F.lit("k").alias("key"))
    sizes = [r["count"] for r in ranking.with_value_bucket(df, ["key"], "value", buckets=64).groupBy("_b").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * 20_000 / 64
    found = {r["share"]: r["quantile"] for r in ranking.quantiles(df, ["key"], [0.0, 0.5, 1.0]).collect()}
    assert found == {0.0: pytest.approx(1 / 7), 0.5: pytest.approx(10_000.5 / 7 - 0.5 / 7 + 0.5 / 7), 1.0: 1e12}


def test_ranks_of_clustered_scores(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    score, label = rng.random(5000) * 1e-9, rng.integers(0, 2, 5000)
    rows = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label, strict=True)], "score double, label int")
    order = np.argsort(score, kind="stable")
    ranks = np.empty(5000)
    ranks[order] = np.arange(1, 5001)
    n = label.sum()
    expected = (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (5000 - n))
    assert metrics.auc(rows, []).first()["auc"] == pytest.approx(expected)


def test_short_quoted_lines_and_mistyped_fields_stay(spark, tmp_path):
    from pyspark.sql import types as T

    from bureaulake.sources import files

    (tmp_path / "a.csv").write_text('a,b,c\n"p,q,r",8\n1,2,3\n1,2,3,4\n')
    rows = files.read_delimited(spark, str(tmp_path / "a.csv"), ["a", "b", "c"]).collect()
    assert [tuple(r)[1:] for r in rows] == [("8", None), ("2", "3")] and rows[0]["a"] == "p,q,r"
    (tmp_path / "b.jsonl").write_text('{"id": "seven", "n": "y"}\n{"id": 3, "n": "z"}\n{"id": 4, "n"\nnothing\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.StringType())])
    assert [tuple(r) for r in files.read_json(spark, str(tmp_path / "b.jsonl"), schema).collect()] == [(None, "y"), (3, "z")]


def test_lines_of_many_blocks(spark):
    lines = spark.range(0, 50_000, 1, 4).select(F.lit("f").alias("file"), (F.col("id") * 10).alias("block"), F.lit("x").alias("value"))
    found = batches.number_lines(lines).agg(F.min("line_no"), F.max("line_no"), F.count_distinct("line_no")).first()
    assert tuple(found) == (1, 50_000, 50_000)


def test_one_bucket_per_micro_batch(spark):
    """Buckets of one row, of many rows and of none: a micro-batch holds one, in their order."""
    table = spark.range(1000).select("id", F.when(F.col("id") == 0, 0).when(F.col("id") < 4, 1).otherwise(3).alias("b"))
    out = jobs.run(jobs.staged(table, F.col("b"), 4, "turns"), jobs.append, "append", "turns-out")
    found = spark.read.schema("id long, b int, batch_id long").parquet(out).groupBy("batch_id").agg(F.min("b"), F.max("b"), F.count("b")).collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0, 1), (1, 1, 1, 3), (3, 3, 3, 996)]


def test_keys_are_delivered_once_across_batches(spark):
    rows = [(1, 0, "2024-01-05"), (1, 1, "2024-01-06"), (2, 0, "2024-01-06"), (2, 1, "2024-01-06"), (None, 0, "2024-01-06"), (None, 1, "2024-01-06"), (3, 1, None)]
    table = spark.createDataFrame(rows, "id long, batch int, day string").withColumn("at", F.col("day").cast("timestamp")).drop("day")
    out = jobs.run(jobs.staged(table, F.col("batch"), 2, "t"), jobs.late_sink(["id"], "at", 2 * 86_400_000), "append", "once")
    kept = sorted((str(r["id"]), r["batch"]) for r in spark.read.parquet(f"{out}/rows").select("id", "batch").collect())
    assert kept == [("1", 0), ("2", 0), ("3", 1), ("None", 0)]


def test_collector_moves_and_times_out(spark):
    """A time-out, results without a request, a decision in two steps; the same transitions in two runs."""
    def message(request, batch, minute, kind, model=None, flag=None, selective=False, models="credit_risk,fraud_detection,loan_amount,income_verification"):
        context = kind == "context"
        return (request, batch, kind, models if context else None, selective if context else None, None, model, flag, (minute + 28_401_120) * 60_000)

    rows = [message("a", 0, 0, "context"), message("a", 0, 1, "result", "credit_risk"), message("a", 1, 2, "result", "fraud_detection", "LOW"),
            message("a", 2, 3, "result", "loan_amount"), message("a", 2, 3, "result", "income_verification"),
            message("b", 0, 0, "context"), message("b", 1, 2, "result", "loan_amount"), message("c", 0, 0, "result", "credit_risk"),
            message("d", 0, 0, "context", selective=True, models="credit_risk"), message("d", 0, 0, "result", "credit_risk"),
            message("z", 3, 60, "context"), message("z", 4, 61, "result", "credit_risk")]
    schema = "request_id string, batch int, kind string, models string, selective boolean, label string, model_type string, flag string, at_ms long"
    table = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("at_ms"))

    def once():
        stream = jobs.staged(table, F.col("batch"), 5, "m").drop("batch")
        return sorted(map(tuple, jobs.rows(jobs.collect(stream, timeout_ms=600_000, delay="1 minute"), "c").collect()))

    expected = [("a", "decide", ""), ("a", "trigger_phase_2", ""), ("b", "timeout", "credit_risk,fraud_detection,income_verification"), ("c", "orphan_results", ""), ("d", "decide", "")]
    assert once() == expected and once() == expected
