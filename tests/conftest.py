from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from bureaulake.session import local_session

    session = local_session(4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SF_DIR)


@pytest.fixture
def column(spark):
    """Evaluate a column function over a list of values: column(fn, values, type) -> list."""
    from pyspark.sql import functions as F

    def evaluate(fn, values, kind="double"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r["out"] for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return evaluate
