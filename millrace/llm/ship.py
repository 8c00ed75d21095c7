"""Sends this package to the executors, whose Python workers import it by name."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import millrace

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once per application.

    Workers keep a module they have imported, and with it the vocabularies and words it remembers.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(millrace.__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace"), "zip", root.parent, root.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
