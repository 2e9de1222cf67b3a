"""Output tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.functions.dates import DAY_PARTITION, event_day
from feedpulse.sources import versions
from feedpulse.sources.schema import DAILY_ROLLUP


def write_actions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Lay an action table out by day, the layout the date-bounded jobs prune on.

    The rebalance hint lets Spark size the files: small days share a task, a day
    that holds a large part of the data is split over several.
    """
    dated = df.withColumn(DAY_PARTITION, event_day()).hint("rebalance", DAY_PARTITION)
    dated.write.mode(mode).partitionBy(DAY_PARTITION).parquet(path)


def daily_rollup_write(
    rollup: DataFrame, path: str, mode: str = "overwrite_day", event_date: date | None = None
) -> None:
    """Store roll-up rows under ``path``, one folder per ``event_date``.

    ``overwrite_day`` replaces the day ``event_date``, also by nothing if it has become
    empty, or without one the days present in ``rollup``; so a rerun or a retry
    leaves one copy. ``append`` adds the rows again.
    """
    rows = rollup.select(*DAILY_ROLLUP.fieldNames())
    if mode == "overwrite_day" and event_date is not None:
        day = rows.where(F.col("event_date") == F.lit(event_date)).drop("event_date")
        day.write.mode("overwrite").parquet(f"{path}/event_date={event_date}")
    elif mode == "overwrite_day":
        writer = rows.write.partitionBy("event_date")
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    elif mode == "append":
        rows.write.partitionBy("event_date").mode("append").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode!r}; use 'overwrite_day' or 'append'")


def write_dims(dims: DataFrame, path: str, as_of: date) -> None:
    """Store users' dimension values as known at the start of ``as_of``, replacing that copy.

    Earlier copies stay for reruns; whoever keeps the folder removes old ones.
    """
    dims.write.mode("overwrite").parquet(f"{path}/as_of={as_of}")


def read_dims(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """The copy ``write_dims`` made for ``as_of``; a missing one is an error."""
    try:
        return spark.read.parquet(f"{path}/as_of={as_of}")
    except AnalysisException as error:
        raise ValueError(f"no dimension values of the days before {as_of} in {path}; backfill them") from error


def daily_rollup_create(spark: SparkSession, table: str) -> None:
    """Create the catalog table for the roll-up if it does not exist yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DAILY_ROLLUP)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (event_date)"
    )


def daily_rollup_commit(rollup: DataFrame, path: str, event_date: date) -> int:
    """Store the roll-up of ``event_date`` in a table of versions, replacing that day at once; the version.

    A run that stops leaves the day as it was. ``daily_rollup_read`` is for readers.
    """
    rows = rollup.select(*DAILY_ROLLUP.fieldNames()).where(F.col("event_date") == F.lit(event_date))
    return versions.replace(path, {event_date.isoformat(): rows})


def daily_rollup_read(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The roll-up of the days first..last as of the newest version; either side may be open."""
    wanted = [
        day
        for day in versions.parts(spark, path)
        if (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())
    ]
    return versions.read(spark, path, DAILY_ROLLUP, wanted)


def daily_rollup_save(rollup: DataFrame, table: str, event_date: date | None = None) -> None:
    """Put the roll-up into a catalog table, replacing ``event_date`` or else the days it contains.

    A day's rows are written to a folder of their own beside the table; then the catalog is told that
    the day is there, in one step. A run that stops before leaves the day as it was. Replaced folders
    stay for those who are reading them.
    """
    spark = rollup.sparkSession
    daily_rollup_create(spark, table)
    rows = rollup.select(*DAILY_ROLLUP.fieldNames())
    wanted = [event_date] if event_date is not None else [r[0] for r in rows.select("event_date").distinct().collect()]
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    for day in wanted:
        folder = f"{place.rstrip('/')}-days/{day}-{uuid.uuid4().hex}"
        rows.where(F.col("event_date") == F.lit(day)).drop("event_date").write.parquet(folder)
        _point_to(spark, table, day, folder)


def _point_to(spark: SparkSession, table: str, day: date, folder: str) -> None:
    partition = f"PARTITION (event_date = DATE '{day}')"
    if spark.sql(f"SHOW PARTITIONS {table} {partition}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {partition} LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
