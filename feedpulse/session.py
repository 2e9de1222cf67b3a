"""Spark session for local runs; on a cluster the submitted session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "feedpulse", **conf: str) -> SparkSession:
    """A local session with the settings the jobs rely on.

    ``conf`` keys use ``__`` for the dots (``spark__sql__...="x"``).
    """
    slots = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", slots)
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the calling line of every column expression takes longer than small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
