"""Where jobs may keep files between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_created: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting, such as a test, gets a folder of
    this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="feedpulse-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever it is; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def entries(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []


def clear(spark: SparkSession) -> None:
    """Delete all scratch files this process has made. For the end of a job, when results are stored."""
    while _created:
        remove(spark, _created.pop())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch space and read it back, so that its users do not compute it again.

    Unlike a cache, the files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
