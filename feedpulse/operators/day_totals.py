"""A kept table of daily totals, rebuilt only for the days that events came for.

Whoever stores new events marks the days they are for, late ones included. A refresh
reads the events of the marked days alone, replaces their rows, and takes the marks away
that it has read. If it stops before that, the days are rebuilt once more, to the same rows.
The reports over all history then start from one row a day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.dates import days, event_day, on_any_day
from feedpulse.functions.measures import is_like, is_view, pct_change, previous_by_date, total
from feedpulse.sources import versions
from feedpulse.sources.scratch import entries, remove

COUNTS = ("feed_events", "likes", "views", "send_messages", "feed_only", "message_only", "both_services")
DAY_TOTALS = T.StructType([T.StructField("date", T.DateType()), *[T.StructField(c, T.LongType()) for c in COUNTS]])
DIRTY = "dirty"


def day_totals(feed: DataFrame, msg: DataFrame, wanted: Iterable[date] | None = None) -> DataFrame:
    """(date, counts) of the wanted days, or all; a day without events has no row.

    Both services are reduced to users' days together, in each task first. Users who are not
    known count in the events, but not as users.
    """
    wanted = None if wanted is None else list(wanted)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def rows(df: DataFrame, feed_events, likes, views, messages) -> DataFrame:
        df = df if wanted is None else on_any_day(df, *wanted)
        return df.where(F.col("time").isNotNull()).select(
            event_day().alias("date"),
            "user_id",
            feed_events.alias("feed_events"),
            likes.alias("likes"),
            views.alias("views"),
            messages.alias("send_messages"),
        )

    feed_rows = rows(feed, one, is_like().cast("long"), is_view().cast("long"), none)
    by_user = feed_rows.unionByName(rows(msg, none, none, none, one)).groupBy("date", "user_id").agg(
        *[total(name) for name in COUNTS[:4]]
    )
    known = F.col("user_id").isNotNull()
    in_feed, in_messenger = F.col("feed_events") > 0, F.col("send_messages") > 0
    return by_user.groupBy("date").agg(
        *[total(name) for name in COUNTS[:4]],
        F.count_if(known & in_feed & ~in_messenger).alias("feed_only"),
        F.count_if(known & in_messenger & ~in_feed).alias("message_only"),
        F.count_if(known & in_feed & in_messenger).alias("both_services"),
    )


def mark_dirty(path: str, *arrived: DataFrame) -> None:
    """Note the days that newly stored events are for."""
    marked = [df.where(F.col("time").isNotNull()).select(event_day().alias("date")).distinct() for df in arrived]
    rows = marked[0]
    for more in marked[1:]:
        rows = rows.unionByName(more)
    rows.distinct().coalesce(1).write.parquet(f"{path}/{DIRTY}/{uuid.uuid4().hex}")


def refresh(feed: DataFrame, msg: DataFrame, path: str) -> list[date]:
    """Rebuild the marked days' rows from the events; the days. What else is kept stays as it is.

    The days are listed on the driver, at most as many as there are days. Rows are kept by month, so
    that a year is twelve small files.
    """
    spark = feed.sparkSession
    marks = [f"{path}/{DIRTY}/{name}" for name in entries(spark, f"{path}/{DIRTY}")]
    if not marks:
        return []
    dirty = sorted(r.date for r in spark.read.schema("date date").parquet(*marks).distinct().collect())
    if dirty:
        new = day_totals(feed, msg, dirty).persist()
        try:
            _replace(spark, new, path, dirty)
        finally:
            new.unpersist()
    for mark in marks:
        remove(spark, mark)
    return dirty


def _replace(spark: SparkSession, new: DataFrame, path: str, dirty: list[date]) -> None:
    changed = {}
    for month in sorted({f"{d:%Y-%m}" for d in dirty}):
        own = new.where(F.date_format("date", "yyyy-MM") == month)
        kept = versions.read(spark, path, DAY_TOTALS, [month])
        others = kept.where(~F.col("date").isin([d for d in dirty if f"{d:%Y-%m}" == month]))
        changed[month] = own.unionByName(others).coalesce(1)
    versions.replace(path, changed)


def read_totals(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The kept rows of the days first..last; either side may be open."""
    months = [
        m
        for m in versions.parts(spark, path)
        if (first is None or m >= f"{first:%Y-%m}") and (last is None or m <= f"{last:%Y-%m}")
    ]
    rows = versions.read(spark, path, DAY_TOTALS, months)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first))
    return rows if last is None else rows.where(F.col("date") <= F.lit(last))


def activity_change(totals: DataFrame, as_of: date) -> DataFrame:
    """What ``reports.activity_change_daily`` says, from the daily totals.

    A change is against the service's last day with events. The window's rows are days.
    """
    before = totals.where(F.col("date") <= F.lit(as_of - days(1)))
    own = {"likes": "feed_events", "views": "feed_events", "send_messages": "send_messages"}
    names = {"likes": "likes_change", "views": "views_change", "send_messages": "messages_change"}
    shown = {c: F.when(F.col(by) > 0, F.col(c)) for c, by in own.items()}
    changes = [pct_change(v, previous_by_date(v), 2).alias(names[c]) for c, v in shown.items()]
    rows = before.select("date", "feed_events", *shown, *changes)
    both = (F.col("feed_events") > 0) & (F.col("send_messages") > 0)
    columns = [x for c in own for x in (c, names[c])]
    return rows.where(both).select("date", *columns).orderBy("date")


def service_overlap(totals: DataFrame) -> DataFrame:
    """What ``dashboards.service_overlap_daily`` says, from the daily totals."""
    return totals.select("date", "feed_only", "message_only", "both_services").orderBy("date")
