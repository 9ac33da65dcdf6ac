"""Sending this package to the executors, for functions that run in Python there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, also where it is not installed. Once for an application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "dryspell.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("dryspell", os.path.relpath(full, root)))
    context.addPyFile(path)
    _sent.add(context.applicationId)
