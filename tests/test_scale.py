"""Many small keys, one very large key, scans per query, and the bookkeeping of trained models."""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from bureaulake import queries as registered
from bureaulake.ml import log, search
from bureaulake.operators import profile, ranking, registry


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_as_of_with_a_million_decisions(spark):
    """One id has a million decisions; no row is copied per day it can be seen."""
    start = F.to_date(F.lit("2024-01-01"))
    audit = spark.range(1_000_000).select(
        F.lit("hot").alias("request_id"), F.date_add(start, (F.col("id") * 7919 % 900).cast("int")).alias("decision_date"), F.col("id").alias("audit_id"), F.lit("APPROVE").alias("decision"))
    audit = audit.filter(~F.dayofyear("decision_date").between(100, 145))  # a gap longer than the reach
    asked = spark.range(1000).select(F.lit("hot").alias("request_id"), F.date_add(start, F.col("id").cast("int")).alias("asked_on"))
    found = registry.visible_decisions(audit, asked)
    assert "Generate" not in plan_of(found) and "explode" not in plan_of(found)
    days = {r["d"]: r["a"] for r in audit.groupBy(F.col("decision_date").alias("d")).agg(F.max("audit_id").alias("a")).collect()}
    import datetime as dt

    rows = found.collect()
    assert len(rows) == 1000
    for r in rows:
        best = next((r["asked_on"] - dt.timedelta(days=k) for k in range(31) if r["asked_on"] - dt.timedelta(days=k) in days), None)
        assert (r["decision_date"], r["audit_id"]) == (best, days.get(best))


@pytest.mark.parametrize("most", [1_000_000, 50])
def test_numbers_of_many_keys_and_a_large_one(spark, most):
    """A hundred thousand keys of three rows, null among them, and one of twenty thousand."""
    small = spark.range(300_000).select(F.when(F.col("id") >= 3, F.floor(F.col("id") / 3)).alias("k"), (F.col("id") % 3 * 10.0).alias("v"))
    df = small.unionByName(spark.range(20_000).select(F.lit(-1).cast("long").alias("k"), (F.col("id") * 0.5).alias("v")))
    n = ranking.row_numbers(df, ["k"], "v", "n", most)
    wrong = n.filter(F.col("n") != F.when(F.col("k") == -1, F.col("v") / 0.5 + 1).otherwise(F.col("v") / 10 + 1)).count()
    assert wrong == 0 and n.count() == 320_000


def test_examples_are_the_smallest_digests(spark):
    """Values whose digests share their first byte, few values, many repeats, long text."""
    many = [f"v{i}" for i in range(3000)]
    same = [v for v in many if hashlib.md5(v.encode()).hexdigest().startswith("3")][:40]
    same = [v for v in same if hashlib.md5(v.encode()).hexdigest()[:2] == hashlib.md5(same[0].encode()).hexdigest()[:2]]
    columns = {"many": many, "same": same * 100, "two": ["x", "y"] * 50, "none": [None] * 5, "long": ["z" * 80]}
    length = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(length)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    found = {r["column"]: r["examples"] for r in profile.examples(df, list(columns)).collect()}
    for name, values in columns.items():
        expected = [v[:50] for v in sorted({v for v in values if v is not None}, key=lambda v: hashlib.md5(v.encode()).hexdigest())[:3]]
        assert found.get(name, []) == expected, name


@pytest.mark.parametrize("key", ["profile_merged", "profile_distribution", "text_patterns"])
def test_tables_are_read_twice(spark, sf_dir, key):
    """One aggregation whose few rows are stored, and one pass over values."""
    plan = plan_of(registered.queries()[key](spark, sf_dir)).split("== Physical Plan ==")[1]
    assert plan.count("customer.parquet") <= 1


def test_grouped_profile_is_that_of_each_group(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_name", "c_acctbal", F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).alias("s"), (F.col("c_custkey") % 2).alias("g"))
    found = {(r["g"], r["column"]): r for r in profile.grouped(df, ["g"]).collect()}
    for g in (0, 1):
        own = df.filter(F.col("g") == g).drop("g")
        for r in profile.missing(own).collect():
            assert found[g, r["column"]]["completeness_pct"] == r["completeness_pct"]
        for r in profile.text_patterns(own).collect():
            assert found[g, r["column"]]["patterns"] == r["patterns"]
        for r in profile.logical_types(own).collect():
            assert found[g, r["column"]]["type"] == r["type"]


# ---- models


def test_log_promotes_once_and_repeats_nothing(spark, tmp_path):
    folder = str(tmp_path / "log")
    first = log.append(spark, folder, "credit_risk", "a", {"auc": 0.8}, "auc", {"depth": 3})
    worse = log.append(spark, folder, "credit_risk", "b", {"auc": 0.7}, "auc")
    equal = log.append(spark, folder, "credit_risk", "c", {"auc": 0.8}, "auc")
    again = log.append(spark, folder, "credit_risk", "b", {"auc": 0.99}, "auc")
    other = log.append(spark, folder, "loan_amount", "a", {"rmse": 5.0}, "rmse", larger=False)
    less = log.append(spark, folder, "loan_amount", "d", {"rmse": 4.0}, "rmse", larger=False)
    assert (first["version"], first["promoted"], first["champion_version"]) == (1, True, None)
    assert (worse["promoted"], worse["champion_version"], equal["promoted"], equal["version"]) == (False, 1, True, 3)
    assert again == worse and other["version"] == 1 and less["promoted"] and less["champion_value"] == 5.0
    assert log.read(spark, folder).count() == 5
    assert json.loads(log.read(spark, folder).filter("run_id = 'a' AND model_type = 'credit_risk'").first()["params"]) == {"depth": 3}


def test_log_with_writers_at_once(spark, tmp_path):
    """Twelve runs at the same time, each sent twice: twelve versions in a row, promoted in the order of the log."""
    folder = str(tmp_path / "log")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: log.append(spark, folder, "credit_risk", f"run-{i // 2}", {"auc": (i // 2) * 7 % 12 / 12}, "auc"), range(24)))
    rows = sorted(log.read(spark, folder).collect(), key=lambda r: r["version"])
    assert [r["version"] for r in rows] == list(range(1, 13)) and len({r["run_id"] for r in rows}) == 12
    best = None
    for r in rows:
        assert r["promoted"] == (best is None or r["metric"] >= best)
        best = r["metric"] if r["promoted"] else best


def test_halving_keeps_the_best(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("request_id"))
    sizes = {}

    def fit(part, params):
        sizes.setdefault(params["x"], []).append(part.count())
        return params["x"]

    found, best = search.halving(rows, [{"x": x} for x in (5, 3, 9, 1, 7, 2, 8, 6)], fit, lambda x: abs(x - 6.2), larger=False)
    assert best == {"x": 6} and [len(v) for v in sizes.values()].count(3) == 2
    assert [sum(1 for r in found if r[1] == k) for k in range(3)] == [8, 4, 2]
    assert sizes[6][2] == 4000 and 800 < sizes[6][0] < 1200 and 1800 < sizes[6][1] < 2200
    assert search.rung(rows, 0.5).join(search.rung(rows, 0.25), "request_id", "left_semi").count() == search.rung(rows, 0.25).count()


def test_selection_finds_what_matters(spark):
    import random

    from bureaulake import catalog
    from bureaulake.ml import models

    rng = random.Random(1)
    rows = [(*(float(rng.randint(0, 9)) for _ in catalog.FEATURES),) for _ in range(600)]
    table = spark.createDataFrame([(str(i), *r, 3 * r[4] + r[9]) for i, r in enumerate(rows)], ["request_id", *catalog.FEATURES, "label"])
    data = models.with_vector(table)
    found = search.select_features(data, classes=False)
    top = [r["feature"] for r in found.orderBy("rank").limit(2).collect()]
    assert top == [catalog.FEATURES[4], catalog.FEATURES[9]]
    chosen = [r["feature"] for r in found.filter("selected").orderBy("rank").collect()]
    again = search.with_selected(data, chosen).select(F.size(models.vector_to_array("features")).alias("w")).distinct().collect()
    assert [r["w"] for r in again] == [len(chosen)] and len(chosen) < 30


def test_draws_stay_in_range():
    for space in (search.LOAN, search.INCOME):
        for params in search.draw(space, 50):
            assert params.keys() == space.keys()
            assert all(low <= params[n] <= high and isinstance(params[n], int) == isinstance(low, int) for n, (low, high, _) in space.items())
