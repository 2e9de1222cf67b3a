"""Schemas of the two action tables and of the roll-up table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_USER = [
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("exp_group", T.IntegerType()),
]

FEED_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("post_id", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("time", T.TimestampType()),
        *_USER,
    ]
)

MESSAGE_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("receiver_id", T.LongType()),
        T.StructField("time", T.TimestampType()),
        *_USER,
    ]
)

ROLLUP_METRICS = [
    "views",
    "likes",
    "messages_received",
    "messages_sent",
    "users_received",
    "users_sent",
]

DAILY_ROLLUP = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("dimension_value", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in ROLLUP_METRICS],
    ]
)

# Spelling of the receiver column found in some message tables.
RECEIVER_ALIASES = {"reciever_id": "receiver_id"}


def conform(df: DataFrame, schema: T.StructType, typed: bool = True) -> DataFrame:
    """Rename known misspellings; fail early on missing columns and on a ``time`` that isn't one.

    ``typed=False`` is for text that is still to be cast.
    """
    df = df.withColumnsRenamed(RECEIVER_ALIASES)
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}; it has {df.columns}")
    if typed and not isinstance(df.schema["time"].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"time must be a timestamp, not {df.schema['time'].dataType.simpleString()}")
    return df
