"""Tables of parts, such as days, whose parts are replaced at once or not at all.

A part's rows are written to a folder of their own first. A list of all parts and
their folders, one file for each version, then says which count; the newest list is the
table. A writer that stops at any step leaves the old list, and with it the old
rows, or the new one. Two writers cannot make the same version: the second one finds it
taken, takes up the other's parts and tries the next.

This rests on the file system refusing to rename onto a file that exists, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedpulse.sources.scratch import entries, remove

LISTS, ROWS = "_versions", "parts"
ATTEMPTS = 20


class Taken(RuntimeError):
    """Another writer was faster, time and again."""


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions there are, oldest first."""
    names = entries(spark, f"{path}/{LISTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def parts(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    """Part to folder (below ``path``) as of a version, or else the newest one; empty before the first."""
    known = versions(spark, path)
    if not known:
        return {}
    chosen = known[-1] if version is None else version
    if chosen not in known:
        raise ValueError(f"{path} has no version {chosen}; it has {known}")
    place, files = _files(spark, f"{path}/{LISTS}/{chosen}.json")
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _propose(spark: SparkSession, path: str, version: int, listed: dict[str, str]) -> bool:
    """Make ``listed`` the given version; False if that exists."""
    aside, files = _files(spark, f"{path}/{LISTS}/{version}-{uuid.uuid4().hex}.new")
    out = files.create(aside, True)
    try:
        out.write(json.dumps(listed).encode())
    finally:
        out.close()
    final, _ = _files(spark, f"{path}/{LISTS}/{version}.json")
    done = not files.exists(final) and files.rename(aside, final)
    if not done:
        files.delete(aside, False)
    return done


def write_aside(rows: DataFrame, path: str) -> str:
    """Write a part's rows where no reader looks yet; the folder, below ``path``."""
    folder = f"{ROWS}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    return folder


def commit(spark: SparkSession, path: str, changed: dict[str, str | None]) -> int:
    """Let the given parts be in the given folders, or (None) be no more; the new version."""
    for _ in range(ATTEMPTS):
        known = versions(spark, path)
        latest = known[-1] if known else 0
        listed = {**parts(spark, path, latest or None), **changed}
        if _propose(spark, path, latest + 1, {k: v for k, v in sorted(listed.items()) if v is not None}):
            return latest + 1
    raise Taken(f"{path}: others keep writing; try again")


def replace(path: str, changed: dict[str, DataFrame]) -> int:
    """Replace parts, all in one version; the new version."""
    spark = next(iter(changed.values())).sparkSession
    return commit(spark, path, {part: write_aside(rows, path) for part, rows in changed.items()})


def read(
    spark: SparkSession, path: str, schema: StructType, wanted: Iterable[str] | None = None, version: int | None = None
) -> DataFrame:
    """The rows of all parts, or of those wanted that exist; other parts' files are not listed."""
    listed = parts(spark, path, version)
    names = listed if wanted is None else [p for p in wanted if p in listed]
    folders = [f"{path}/{listed[p]}" for p in names]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete lists but the newest ``keep`` and folders in none of those; the number of folders.

    For a time without writers: what a writer has put aside is not listed yet.
    """
    known = versions(spark, path)
    kept = {f for v in known[-keep:] for f in parts(spark, path, v).values()}
    gone = [f"{ROWS}/{name}" for name in entries(spark, f"{path}/{ROWS}") if f"{ROWS}/{name}" not in kept]
    for version in known[:-keep]:
        remove(spark, f"{path}/{LISTS}/{version}.json")
    for folder in gone:
        remove(spark, f"{path}/{folder}")
    return len(gone)
