"""Sends the package to the executors of a session, so that Python workers can import it there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: all modules as a zip that Spark serves from the driver."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    place = tempfile.mkdtemp(prefix="ship-")
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    path = os.path.join(place, "bureaulake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    packed.write(file, os.path.join("bureaulake", os.path.relpath(file, root)))
    spark.sparkContext.addPyFile(path)
