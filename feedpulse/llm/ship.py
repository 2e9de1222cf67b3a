"""Sending this package to the executors, for sessions that weren't started with it."""

from __future__ import annotations

import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Add the package's source to the session's Python files, once; the driver serves the archive."""
    context = spark.sparkContext
    if hasattr(context, "feedpulse_archive"):
        return
    # The driver's own folder; it goes with the process.
    context.feedpulse_archive = tempfile.TemporaryDirectory(prefix="feedpulse-", ignore_cleanup_errors=True)
    archive = f"{context.feedpulse_archive.name}/feedpulse.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(PACKAGE.rglob("*.py")):
            file.write(source, f"{PACKAGE.name}/{source.relative_to(PACKAGE)}")
    context.addPyFile(archive)


def shipping(function):
    """For functions of a session and more: ship first."""

    @wraps(function)
    def run(spark: SparkSession, *rest):
        ship(spark)
        return function(spark, *rest)

    return run
