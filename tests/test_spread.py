"""Tables of few bytes whose rows bring much work, and requests whose messages lie far apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bureaulake.queries import decision_queries, model_queries, profile_queries, report_queries, streaming_queries
from bureaulake.sources import reports


@pytest.fixture
def customers(spark, tmp_path):
    """Writes customers of the given keys into one file and returns its folder."""
    def make(keys):
        spark.createDataFrame([(k,) for k in keys], "c_custkey long").select(
            "c_custkey", F.concat(F.lit("Customer#"), "c_custkey").alias("c_name"), (F.col("c_custkey") % 25).cast("int").alias("c_nationkey"),
            (F.col("c_custkey") * 1.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
        return str(tmp_path)

    return make


def test_work_on_one_small_file_is_shared(spark, customers):
    d = customers(range(1, 12_001))
    made = reports.lines(spark, d).filter("line like '%request_id%'")  # a filter that needs the whole line
    assert made.rdd.getNumPartitions() > 1 and reports.lines(spark, d).count() == 12_000
    assert profile_queries.upload(spark, d).rdd.getNumPartitions() > 1


def test_learners_read_many_files(spark):
    stored = model_queries._stored(spark.range(0, 50_000, 1, 1), "rows")
    assert len(stored.inputFiles()) == 3 and stored.count() == 50_000


def test_requests_of_many_years_are_collected(spark, customers):
    """Keys are minutes: messages of the first request may come after those of the last, years later."""
    d = customers([*range(1, 40), *range(3_000_000, 3_000_040)])
    found = {tuple(r) for r in streaming_queries.stream_collect(spark, d).collect()}
    batch = decision_queries.collect_predictions(spark, d).select("request_id", "state")
    assert found == {tuple(r) for r in batch.collect()} and len(found) == 79


def test_flat_columns_are_found_once(spark, customers):
    """Conditions read stored columns; nothing of the report is parsed again for them."""
    kept = report_queries.restore_required(spark, customers(range(1, 13)))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "jsontostructs" not in plan.lower() and kept.count() > 0
