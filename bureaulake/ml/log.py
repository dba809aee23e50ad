"""Append-only log of trained model versions, kept as one small file per version.

A version file is created only if there is none of its number, so two writers can't both become version n: the one that comes second
reads the log again and decides anew. Its promotion therefore always compares with the champion it really follows. A run that is
repeated finds its own row and adds nothing.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("model_type string, version int, run_id string, metric_name string, metric double, promoted boolean, champion_version int, champion_value double, "
          "params string, metrics string, model_path string")


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, folder: str) -> list[dict]:
    """The rows of one model type in order of version: one per training, so few."""
    system, path = _place(spark, folder)
    if not system.exists(path):
        return []
    rows = spark.read.schema(SCHEMA).json(folder).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["version"])


def _create(spark: SparkSession, file: str, text: str) -> bool:
    """Writes a file that doesn't exist yet; False if it does."""
    system, path = _place(spark, file)
    try:
        out = system.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()) or system.exists(path):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def append(spark: SparkSession, folder: str, model_type: str, run_id: str, metrics: dict[str, float], primary: str, params: dict | None = None,
           model_path: str | None = None, larger: bool = True) -> dict:
    """The row of this run, new or found. It is promoted if there is no champion or its primary metric is at least as good."""
    own = f"{folder}/{model_type}"
    while True:
        rows = _versions(spark, own)
        for row in rows:
            if row["run_id"] == run_id:
                return row
        champion = next((r for r in reversed(rows) if r["promoted"]), None)
        value = float(metrics[primary])
        better = champion is None or (value >= champion["metric"] if larger else value <= champion["metric"])
        version = rows[-1]["version"] + 1 if rows else 1
        row = {"model_type": model_type, "version": version, "run_id": run_id, "metric_name": primary, "metric": value, "promoted": better,
               "champion_version": champion and champion["version"], "champion_value": champion and champion["metric"],
               "params": json.dumps(params or {}, sort_keys=True), "metrics": json.dumps(metrics, sort_keys=True), "model_path": model_path}
        if _create(spark, f"{own}/v{version:08d}.json", json.dumps(row) + "\n"):
            return row


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All versions of all model types."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(folder)
