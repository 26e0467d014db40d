"""Gives the executors' Python workers this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application, once; Spark serves the archive to every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="sievewright-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(name)
    _shipped.add(context.applicationId)
