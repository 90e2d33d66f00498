"""Makes this package importable on executors that have no copy of it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the application once; Spark serves them to every executor."""
    context = spark.sparkContext
    if context.applicationId in _done:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="wattloom-"), "wattloom-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(home)))
    context.addPyFile(path)
    _done.add(context.applicationId)
