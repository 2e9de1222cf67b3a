"""Data behind the three dashboards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, event_day, on_any_day, on_days
from feedpulse.functions.measures import ctr_percent, likes, pct_change, total, views
from feedpulse.operators.reports import in_feed, in_messenger, service_user_days
from feedpulse.operators.rollup import user_demographics

BREAKDOWNS = ("gender", "age_group", "os", "source", "country", "city")


def operational_comparison(feed: DataFrame, msg: DataFrame, as_of: date) -> DataFrame:
    """Key metrics of yesterday beside those of the same weekday a week earlier."""
    current, earlier = as_of - days(1), as_of - days(8)
    user_days = service_user_days(
        on_any_day(feed, current, earlier), on_any_day(msg, current, earlier)
    )
    by_day = (
        user_days.groupBy("date")
        .agg(
            F.count_if(in_feed()).alias("dau_feed"),
            F.count_if(in_messenger()).alias("dau_message"),
            F.count("user_id").alias("dau_both"),
            total("likes"),
            total("views"),
            total("messages"),
        )
        .withColumn("ctr", ctr_percent())
    )
    metrics = [c for c in by_day.columns if c != "date"]
    rows = by_day.select("date", *[F.col(m).cast("double") for m in metrics]).unpivot(
        "date", metrics, "metric", "value"
    )

    def on(day: date):
        return F.max(F.when(F.col("date") == F.lit(day), F.col("value")))

    compared = rows.groupBy("metric").agg(
        on(current).alias("yesterday"), on(earlier).alias("week_ago")
    )
    change = pct_change(F.col("yesterday"), F.col("week_ago"), 2)
    return compared.withColumn("change_percent", change)


def audience_breakdown(
    feed: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Daily active users, likes and views in total and by each user attribute.

    A day's rows depend on that day alone, so a table of them can be kept and
    extended by the days ``first`` to ``last``; without them, all days are worked out.
    Events are first added up per day, user and attribute values; only those rows
    are repeated for the dimensions.
    """
    events = on_days(feed, first, last)
    labelled = user_demographics(events.withColumn("date", event_day()))
    user_days = labelled.groupBy("date", "user_id", *BREAKDOWNS).agg(likes(), views())
    rows = user_days.withColumn("total", F.lit("all")).unpivot(
        ["date", "user_id", "likes", "views"],
        ["total", *BREAKDOWNS],
        "dimension",
        "dimension_value",
    )
    by_user = rows.groupBy("date", "dimension", "dimension_value", "user_id").agg(
        total("likes"), total("views")
    )
    return by_user.groupBy("date", "dimension", "dimension_value").agg(
        F.count("user_id").alias("users"), total("likes"), total("views")
    )


def service_overlap_daily(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """Per day: users of the feed only, of the messenger only, and of both."""
    return (
        service_user_days(feed, msg)
        .groupBy("date")
        .agg(
            F.count_if(in_feed() & ~in_messenger()).alias("feed_only"),
            F.count_if(in_messenger() & ~in_feed()).alias("message_only"),
            F.count_if(in_feed() & in_messenger()).alias("both_services"),
        )
        .orderBy("date")
    )
