"""First active dates kept in a table laid out like the events, so that joining them moves nothing.

Events and first dates are bucketed by user and salt. The salt is 0, except in events
of users who have a large share of all events when these are stored: theirs are dealt to
``SALTS`` more values, and their first date is in the table once for each. So a user with
a third of the events has them in many buckets, and every bucket of the one table
still meets exactly one of the other.

The kept table is a view on the newest of its versions; replacing the view is what makes
a new version count.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.functions.dates import DAY_PARTITION, event_day
from feedpulse.operators.retention import HOT_USERS

BUCKETS, SALTS = 64, 63
KEY = ("user_id", "salt")


def _bucketed(rows: DataFrame, table: str, path: str, buckets: int, mode: str, by_day: bool) -> None:
    # Dealt like the buckets first, so that a task has one bucket's rows and writes one file (a day).
    writer = rows.repartition(buckets, *KEY).write.bucketBy(buckets, *KEY).mode(mode).option("path", path)
    (writer.partitionBy(DAY_PARTITION) if by_day else writer).saveAsTable(table)


def _rows(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def hot_now(spark: SparkSession, name: str, hot_users: int = HOT_USERS) -> DataFrame | None:
    """Users with more than 1/``hot_users`` of the events so far: ``hot_users`` at most. None before the first."""
    known = _rows(spark, name)
    if known is None:
        return None
    own = known.where("salt = 0")
    events = own.agg(F.sum("events")).scalar()
    return own.where(F.col("events") * hot_users > events).select("user_id", F.lit(True).alias("hot"))


def store_events(
    feed: DataFrame,
    table: str,
    path: str,
    first_seen: str,
    hot_users: int = HOT_USERS,
    buckets: int = BUCKETS,
    salts: int = SALTS,
) -> None:
    """Append events to the bucketed table, by day. The users known as hot by then come from ``first_seen``.

    Events without a user are dealt like those of hot users.
    """
    hot = hot_now(feed.sparkSession, first_seen, hot_users)
    rows = feed.withColumn(DAY_PARTITION, event_day())
    dealt = (F.pmod(F.xxhash64("time", "source"), F.lit(salts)) + 1).cast("int")
    if hot is None:
        rows = rows.withColumn("salt", F.when(F.col("user_id").isNull(), dealt).otherwise(F.lit(0)))
    else:
        is_hot = F.col("user_id").isNull() | F.col("hot").isNotNull()
        rows = rows.join(F.broadcast(hot), "user_id", "left").withColumn("salt", F.when(is_hot, dealt).otherwise(F.lit(0)))
        rows = rows.drop("hot")
    _bucketed(rows, table, path, buckets, "append", by_day=True)


def extend_first_seen(
    feed: DataFrame,
    name: str,
    path: str,
    hot_users: int = HOT_USERS,
    buckets: int = BUCKETS,
    salts: int = SALTS,
) -> None:
    """Bring events, each once, into the first dates kept as ``name``; earlier days lower them.

    Only ``feed`` and the kept table are read. A user who was hot once keeps a row for each salt, since
    stored events may have any.
    """
    spark = feed.sparkSession
    new = feed.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min(event_day()).alias("first_action"), F.count("*").alias("events"), F.lit(False).alias("salted")
    )
    known = _rows(spark, name)
    if known is not None:
        both = known.where("salt = 0").drop("salt").unionByName(new)
        new = both.groupBy("user_id").agg(
            F.min("first_action").alias("first_action"), F.sum("events").alias("events"), F.max("salted").alias("salted")
        )
    all_events = new.agg(F.sum("events")).scalar()
    salted = F.col("salted") | F.coalesce(F.col("events") * hot_users > all_events, F.lit(False))
    rows = new.withColumn("salted", salted).select(
        "user_id",
        F.explode(F.sequence(F.lit(0), F.when(F.col("salted"), F.lit(salts)).otherwise(F.lit(0)))).alias("salt"),
        "first_action",
        "events",
        "salted",
    )
    version = f"{name}_{uuid.uuid4().hex}"
    _bucketed(rows, version, f"{path}/{version}", buckets, "error", by_day=False)
    old = _version(spark, name) if known is not None else None
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    if old is not None:
        spark.sql(f"DROP TABLE IF EXISTS {old}")  # the files stay for readers; the table's folder can be cleaned later


def _version(spark: SparkSession, name: str) -> str:
    """The table that the view shows."""
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()["data_type"]
    return text.rsplit(" ", 1)[1]


def add_day(
    feed: DataFrame, events: str, first_seen: str, path: str, hot_users: int = HOT_USERS, buckets: int = BUCKETS
) -> None:
    """What a day's job does with its events: store them, and bring them into the first dates."""
    store_events(feed, events, f"{path}/events", first_seen, hot_users, buckets)
    extend_first_seen(feed, first_seen, f"{path}/first-seen", hot_users, buckets)


def first_action_date(spark: SparkSession, events: str, first_seen: str) -> DataFrame:
    """What ``retention.first_action_date`` says, from the kept tables, without an exchange."""
    firsts = spark.table(first_seen).select(*KEY, "first_action")
    joined = spark.table(events).join(firsts, list(KEY), "left")
    return joined.select("user_id", F.col(DAY_PARTITION).alias("action_time"), "source", "first_action")


def cohort_retention(spark: SparkSession, events: str, first_seen: str, first: date, last: date) -> DataFrame:
    """(source, first_action, action_time, retention) of the users whose first day lies in first..last.

    Cohorts come from the kept table; of the events, only days since ``first`` are read, and what is shuffled are
    the cohorts' users once a task, source and day.
    """

    def between(day: Column) -> Column:
        return day.between(F.lit(first), F.lit(last))

    cohort = spark.table(first_seen).where(between(F.col("first_action"))).select(*KEY, "first_action")
    rows = spark.table(events).where(F.col(DAY_PARTITION) >= F.lit(first))
    days = rows.join(cohort, list(KEY)).select("user_id", "source", "first_action", F.col(DAY_PARTITION).alias("action_time"))
    return days.distinct().groupBy("source", "first_action", "action_time").agg(F.count("*").alias("retention"))
