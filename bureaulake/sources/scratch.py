"""Folders for data a query writes and reads back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's checkpoint directory.

    Only a session without ``spark.checkpoint.dir`` (local tests) gets a temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext.getCheckpointDir()
        base = current.rsplit("/", 1)[0] if current else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="bureaulake-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """A table stored below the shared folder and read again: what is used several times is worked out once and survives lost executors.

    ``rows`` bounds the rows of a file (0: no bound), so that many tasks share the reading of a table of few bytes.
    """
    path = folder(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
