"""Session defaults for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture costs several round trips per column function; plans here have thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or os.cpu_count() or 8
    builder = SparkSession.builder.master(f"local[{cores}]").appName("bureaulake")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores)).config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
