"""The two action tables derived from the generic ``events`` test table.

Every event becomes exactly one feed or messenger action; none is dropped. The
users' 30 days of events are moved in time, by rules on their id, so that they
arrive, pause and leave at different dates, and their attributes are made up
from their id, with some that change or are missing.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_DAY = date(2024, 1, 30)
FIRST_DAY = date(2023, 4, 1)  # no event is moved to a day before
CHANGE_DAY = date(2024, 1, 20)
AS_OF = date(2024, 1, 31)
AS_OF_TS = datetime(2024, 1, 30, 18, 7)
AA_WEEK = (date(2024, 1, 15), date(2024, 1, 21))
AB_WEEK = (date(2024, 1, 22), date(2024, 1, 28))
CAMPAIGN = date(2024, 1, 1)


# How many days before the last day an event is moved to. Most users keep their
# 30 days; some squeeze them into 10 or 5, others stretch them over 270. A third
# of the users leave up to 27 days early.
BACK = f"datediff(DATE '{LAST_DAY}', to_date(ts))"
SPAN = "CASE user_id % 5 WHEN 2 THEN 10 WHEN 3 THEN 5 WHEN 4 THEN 270 ELSE 30 END"
LEFT_EARLY = "CASE WHEN user_id % 3 = 2 THEN (user_id * 11) % 28 ELSE 0 END"
TIME = (
    "CAST(ts AS TIMESTAMP)"
    f" + make_dt_interval(CAST({BACK} - ({LEFT_EARLY} + ({BACK} * {SPAN}) div 30) AS INT))"
)
CHANGED = f"to_date(time) >= DATE '{CHANGE_DAY}'"


def actions(events: DataFrame) -> DataFrame:
    """All events with their moved time, their service and the user's attributes."""
    return events.withColumn("time", F.expr(TIME)).selectExpr(
        "event_id",
        "event_type",
        "props",
        "user_id",
        "time",
        """CASE WHEN user_id % 10 = 9 THEN 'message' WHEN user_id % 10 = 4 THEN 'feed'
             WHEN event_type IN ('purchase', 'error') THEN 'message' ELSE 'feed' END AS service""",
        "CAST(user_id % 2 AS INT) AS gender",
        "CASE WHEN user_id % 37 <> 11 THEN CAST(14 + (user_id * 7) % 50 AS INT) END AS age",
        "concat('country-', user_id % 25) AS country",
        "concat('country-', user_id % 25, '-', user_id % 3) AS city",
        f"""CASE WHEN user_id % 31 = 7 THEN NULL WHEN user_id % 11 = 0 AND {CHANGED} THEN 'Web'
             WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os""",
        """CASE WHEN ((user_id div 3) % 5 < 2) <> (user_id % 13 = 4 AND event_id % 2 = 0)
             THEN 'ads' ELSE 'organic' END AS source""",
        f"""CAST(((user_id * 13) div 7 + CASE WHEN user_id % 29 = 3 AND {CHANGED} THEN 1 ELSE 0 END)
             % 5 AS INT) AS exp_group""",
    )


USER_COLUMNS = ["gender", "age", "country", "city", "os", "source", "exp_group"]


def feed_from_events(events: DataFrame) -> DataFrame:
    """``feed_actions``: clicks, and everything done by a few users, are likes; the rest views."""
    action = "CASE WHEN event_type = 'click' OR user_id % 17 = 5 THEN 'like' ELSE 'view' END"
    return (
        actions(events)
        .where("service = 'feed'")
        .selectExpr(
            "user_id", "event_id AS post_id", f"{action} AS action", "time", *USER_COLUMNS
        )
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """``message_actions``: the receiver is a neighbour of the sender, found in ``props``."""
    receiver = "abs(user_id + CAST(get_json_object(props, '$.k') AS INT) - 50)"
    return (
        actions(events)
        .where("service = 'message'")
        .selectExpr("user_id", f"{receiver} AS receiver_id", "time", *USER_COLUMNS)
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream."""
    schema = read_events(spark, folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def feed_actions(spark: SparkSession, folder: str) -> DataFrame:
    return feed_from_events(read_events(spark, folder))


def message_actions(spark: SparkSession, folder: str) -> DataFrame:
    return messages_from_events(read_events(spark, folder))
