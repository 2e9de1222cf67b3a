"""Readers for the action tables: Parquet or other files, CSV, catalog tables, JDBC, streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.sources.schema import FEED_ACTIONS, MESSAGE_ACTIONS, RECEIVER_ALIASES, conform

ACTION_TABLES = {"feed_actions": FEED_ACTIONS, "message_actions": MESSAGE_ACTIONS}


def read_actions(spark: SparkSession, name: str, path: str, format: str = "parquet") -> DataFrame:
    """Columnar files (Parquet, ORC) of ``feed_actions`` or ``message_actions``."""
    return conform(spark.read.format(format).load(path), ACTION_TABLES[name])


def read_actions_csv(spark: SparkSession, name: str, path: str, **options: str) -> DataFrame:
    """CSV files with a header line.

    The columns are matched by the header's names, in any order, and cast to the
    declared types; a value that cannot be cast fails the job.
    """
    schema = ACTION_TABLES[name]
    raw = conform(spark.read.options(header=True, **options).csv(path), schema, typed=False)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_actions_table(spark: SparkSession, name: str, db: str | None = None) -> DataFrame:
    """A catalog table, in the given database or the current one."""
    table = name if db is None else f"{db}.{name}"
    return conform(spark.table(table), ACTION_TABLES[name])


def read_actions_jdbc(
    spark: SparkSession,
    name: str,
    url: str,
    lower: str,
    upper: str,
    partitions: int,
    db: str | None = None,
    **options: str,
) -> DataFrame:
    """A table of a database server, read in parallel slices of ``time``."""
    table = name if db is None else f"{db}.{name}"
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", "time")
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
    )
    return conform(reader.options(**options).load(), ACTION_TABLES[name])


def stream_actions(
    spark: SparkSession, name: str, path: str, format: str = "parquet", **options: str
) -> DataFrame:
    """A folder that keeps receiving files, as a stream.

    Files that carry their schema are read with the one that is there when the stream starts, so
    that a known misspelling is renamed and a missing column is an error, as for
    tables. A folder without files, and formats without a schema, have the declared one.
    """
    schema = ACTION_TABLES[name]
    if format in ("parquet", "orc"):
        try:
            schema = spark.read.format(format).options(**options).load(path).schema
        except AnalysisException:
            pass  # nothing there yet
    stream = spark.readStream.format(format).schema(schema).options(**options).load(path)
    return conform(stream, ACTION_TABLES[name])


def with_event_time(df: DataFrame) -> DataFrame:
    """``time`` as TIMESTAMP, which watermarks require (zone-less input is read as UTC)."""
    if isinstance(df.schema["time"].dataType, T.TimestampType):
        return df
    return df.withColumn("time", F.col("time").cast("timestamp"))


__all__ = [
    "ACTION_TABLES",
    "RECEIVER_ALIASES",
    "read_actions",
    "read_actions_csv",
    "read_actions_jdbc",
    "read_actions_table",
    "stream_actions",
    "with_event_time",
]
