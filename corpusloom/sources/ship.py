"""The package on the executors: they import what a query's Python functions name."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's modules to a session's executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom"), "corpusloom.zip")  # served by the driver from there
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "corpusloom")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
