"""Daily feed report and whole-service report.

Every window here is ordered by date over frames that hold one row per day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, event_day, last_days, on_days
from feedpulse.functions.measures import (
    ctr_percent,
    is_like,
    is_view,
    likes,
    pct_change,
    previous_by_date,
    share_percent,
    total,
    views,
)


def service_user_days(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """One row per date and user with their activity in both services."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    feed_rows = feed.select(
        event_day().alias("date"),
        "user_id",
        one.alias("feed_events"),
        is_like().cast("long").alias("likes"),
        is_view().cast("long").alias("views"),
        none.alias("messages"),
    )
    msg_rows = msg.select(
        event_day().alias("date"),
        "user_id",
        none.alias("feed_events"),
        none.alias("likes"),
        none.alias("views"),
        one.alias("messages"),
    )
    sums = ["feed_events", "likes", "views", "messages"]
    stacked = feed_rows.unionByName(msg_rows)
    return stacked.groupBy("date", "user_id").agg(*[total(name) for name in sums])


def in_feed() -> Column:
    return F.col("user_id").isNotNull() & (F.col("feed_events") > 0)


def in_messenger() -> Column:
    return F.col("user_id").isNotNull() & (F.col("messages") > 0)


def feed_daily_metrics(feed: DataFrame, as_of: date) -> DataFrame:
    """Active users, likes, views and CTR of the last 7 full days."""
    by_day = (
        last_days(feed, as_of)
        .groupBy(event_day().alias("date"))
        .agg(F.count_distinct("user_id").alias("dau"), likes(), views())
    )
    return by_day.withColumn("ctr", ctr_percent()).orderBy("date")


def feed_report_row(daily: DataFrame) -> DataFrame:
    """The latest day's values with the period they are reported for."""
    metrics = ["likes", "views", "dau", "ctr"]
    last = F.max_by(F.struct(*metrics), "date").alias("last")
    row = daily.agg(F.min("date").alias("period_start"), F.max("date").alias("period_end"), last)
    return row.select("period_start", "period_end", *[F.col(f"last.{m}") for m in metrics])


def dau_by_service(feed: DataFrame, msg: DataFrame, as_of: date) -> DataFrame:
    """Active users of the feed, the messenger and either, with their day-on-day change.

    Days without activity in one of the services are left out, and each
    service's previous day is the last one on which it had activity.
    """
    user_days = service_user_days(last_days(feed, as_of), last_days(msg, as_of))
    by_day = user_days.groupBy("date").agg(
        F.count_if(in_feed()).alias("dau_feed"),
        F.count_if(in_messenger()).alias("dau_message"),
        F.count("user_id").alias("dau_both"),
    )
    columns = [F.col("date")]
    for service in ("feed", "message", "both"):
        dau = F.col(f"dau_{service}")
        previous = previous_by_date(F.nullif(dau, F.lit(0)))
        columns += [dau, pct_change(dau, previous, 1).alias(f"change_{service}")]
    present = (F.col("dau_feed") > 0) & (F.col("dau_message") > 0)
    return by_day.select(*columns).where(present).orderBy("date")


def new_users_by_source(feed: DataFrame, msg: DataFrame, as_of: date) -> DataFrame:
    """Users by the day they first appear within the last 7 days, per service and source.

    "New" is relative to the 7-day window, so its first day counts everyone
    active on it; a user seen with two sources counts once for each.
    """
    columns = ["user_id", "source", event_day().alias("day")]
    stacked = (
        last_days(feed, as_of)
        .select(F.lit("feed").alias("service"), *columns)
        .unionByName(last_days(msg, as_of).select(F.lit("message").alias("service"), *columns))
    )
    firsts = stacked.groupBy("service", "user_id", "source").agg(F.min("day").alias("date"))

    def new(service: str, source: str | None = None) -> Column:
        wanted = F.col("service") == service
        if source is not None:
            wanted = wanted & (F.col("source") == source)
        return F.count_if(wanted)

    aggregates = []
    for service in ("feed", "message"):
        aggregates += [
            new(service).alias(f"rows_{service}"),
            new(service, "organic").alias(f"new_organic_{service}"),
            new(service, "ads").alias(f"new_ads_{service}"),
        ]
    by_day = firsts.groupBy("date").agg(*aggregates)

    so_far = Window.orderBy("date")
    selected = [F.col("date")]
    for service in ("feed", "message"):
        organic, ads = F.col(f"new_organic_{service}"), F.col(f"new_ads_{service}")
        both = organic + ads
        previous = previous_by_date(F.when(F.col(f"rows_{service}") > 0, both))
        selected += [
            organic,
            F.sum(organic).over(so_far).alias(f"total_organic_{service}"),
            ads,
            F.sum(ads).over(so_far).alias(f"total_ads_{service}"),
            pct_change(both, previous, 2).alias(f"change_{service}"),
        ]
    rows = ["rows_feed", "rows_message"]
    in_both = (F.col(rows[0]) > 0) & (F.col(rows[1]) > 0)
    return by_day.select(*selected, *rows).where(in_both).drop(*rows).orderBy("date")


def service_growth_series(new_users: DataFrame) -> DataFrame:
    """Running number of users per service, from ``new_users_by_source``."""
    return new_users.select(
        "date",
        (F.col("total_ads_feed") + F.col("total_organic_feed")).alias("users_feed"),
        (F.col("total_ads_message") + F.col("total_organic_message")).alias("users_message"),
    )


def _share_counts(feed: DataFrame, as_of: date) -> DataFrame:
    os, source = F.col("os"), F.col("source")
    return (
        last_days(feed, as_of)
        .groupBy(event_day().alias("date"))
        .agg(
            F.count_if(os == "iOS").alias("ios"),
            F.count_if(os == "Android").alias("android"),
            F.count_if((source == "ads") & os.isNotNull()).alias("ads"),
            F.count_if((source == "organic") & os.isNotNull()).alias("organic"),
            # Whether the day has events of the source at all, with or without an os.
            F.count_if(source == "ads").alias("ads_events"),
            F.count_if(source == "organic").alias("organic_events"),
        )
    )


def _shares(*pairs: tuple[str, str]) -> list[Column]:
    columns = []
    for one, other in pairs:
        columns += [
            share_percent(F.col(one), F.col(other), 1).alias(f"{one}_share"),
            share_percent(F.col(other), F.col(one), 1).alias(f"{other}_share"),
        ]
    return columns


def _both_os() -> Column:
    return (F.col("ios") > 0) & (F.col("android") > 0)


def _both_sources() -> Column:
    return (F.col("ads_events") > 0) & (F.col("organic_events") > 0)


def os_share_daily(feed: DataFrame, as_of: date) -> DataFrame:
    """Share of events on iOS and on Android; days lacking either are left out."""
    counts = _share_counts(feed, as_of).where(_both_os())
    return counts.select("date", *_shares(("ios", "android"))).orderBy("date")


def source_share_daily(feed: DataFrame, as_of: date) -> DataFrame:
    """Share of events (with a known os) of ads and organic users."""
    counts = _share_counts(feed, as_of).where(_both_sources())
    return counts.select("date", *_shares(("ads", "organic"))).orderBy("date")


def traffic_shares(feed: DataFrame, as_of: date) -> DataFrame:
    """Both shares side by side for the days that have both, from one pass over the feed."""
    counts = _share_counts(feed, as_of).where(_both_os() & _both_sources())
    return counts.select("date", *_shares(("ios", "android"), ("ads", "organic"))).orderBy("date")


def activity_change_daily(feed: DataFrame, msg: DataFrame, as_of: date) -> DataFrame:
    """Likes, views and messages of every day before ``as_of`` with their change."""
    yesterday = as_of - days(1)
    date_column = event_day().alias("date")
    feed_days = on_days(feed, None, yesterday).groupBy(date_column).agg(likes(), views())
    msg_days = (
        on_days(msg, None, yesterday)
        .groupBy(date_column)
        .agg(F.count("*").alias("send_messages"))
    )

    def with_change(df: DataFrame, **columns: str) -> DataFrame:
        return df.withColumns(
            {
                change: pct_change(F.col(name), previous_by_date(F.col(name)), 2)
                for name, change in columns.items()
            }
        )

    feed_days = with_change(feed_days, likes="likes_change", views="views_change")
    msg_days = with_change(msg_days, send_messages="messages_change")
    return (
        feed_days.join(msg_days, "date")
        .select(
            "date",
            "likes",
            "likes_change",
            "views",
            "views_change",
            "send_messages",
            "messages_change",
        )
        .orderBy("date")
    )


def service_report_row(dau: DataFrame, new_users: DataFrame, activity: DataFrame) -> DataFrame:
    """The eight values of the whole-service report, each with its change.

    Inputs: ``dau_by_service``, ``new_users_by_source``, ``activity_change_daily``;
    the latest row of each is used.
    """

    def latest(df: DataFrame, section: str, values: dict[str, tuple[Column, Column]]) -> DataFrame:
        lines = [
            F.struct(
                F.lit(section).alias("section"),
                F.lit(metric).alias("metric"),
                value.cast("long").alias("value"),
                change.alias("change_percent"),
            )
            for metric, (value, change) in values.items()
        ]
        last = df.agg(F.max_by(F.array(*lines), "date").alias("lines"))
        return last.select(F.inline("lines"))

    c = F.col
    dau_lines = latest(
        dau,
        "dau",
        {s: (c(f"dau_{s}"), c(f"change_{s}")) for s in ("feed", "message", "both")},
    )
    new_lines = latest(
        new_users,
        "new_users",
        {
            s: (c(f"new_organic_{s}") + c(f"new_ads_{s}"), c(f"change_{s}"))
            for s in ("feed", "message")
        },
    )
    activity_lines = latest(
        activity,
        "activity",
        {
            "likes": (c("likes"), c("likes_change")),
            "views": (c("views"), c("views_change")),
            "messages": (c("send_messages"), c("messages_change")),
        },
    )
    return dau_lines.unionByName(new_lines).unionByName(activity_lines)
