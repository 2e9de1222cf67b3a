"""Activity in 15-minute buckets, interquartile bands and anomaly alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, midnight, time_span
from feedpulse.functions.measures import (
    ctr_percent,
    is_like,
    is_view,
    likes,
    pct_change,
    total,
    views,
)

BUCKET = "15 minutes"
FEED_METRICS = ("dau", "likes", "views")
ALL_METRICS = ("dau", "likes", "views", "ctr", "message_users", "messages_sent")


def bucket_start(column: str = "time") -> Column:
    return F.window(column, BUCKET)["start"].alias("bucket")


def bucket_labels() -> list[Column]:
    """Date and HH:mm of a bucket, the two columns the series are ordered by."""
    return [
        F.to_date("bucket").alias("date"),
        F.date_format("bucket", "HH:mm").alias("minutes"),
    ]


def closed_span(as_of_ts: datetime) -> tuple[datetime, datetime]:
    """From the start of yesterday to the end of the last closed bucket."""
    end = as_of_ts.replace(minute=as_of_ts.minute // 15 * 15, second=0, microsecond=0)
    return midnight(as_of_ts.date()) - days(1), end


def activity_series(
    feed: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Active users (exact), likes and views of every bucket that has events."""
    by_bucket = (
        time_span(feed, start, end)
        .groupBy(bucket_start())
        .agg(F.count_distinct("user_id").alias("dau"), likes(), views())
    )
    return by_bucket.select(*bucket_labels(), *FEED_METRICS)


def fill_gaps(series: DataFrame, metrics: Sequence[str] = FEED_METRICS) -> DataFrame:
    """Add the buckets without events, with zeros (and no CTR), between the first and the last one.

    Every bucket is repeated up to the next one in the series. The window has no
    partition key; its rows are buckets.
    """
    at = F.to_timestamp(F.concat_ws(" ", "date", "minutes"), "yyyy-MM-dd HH:mm")
    step = F.expr(f"INTERVAL {BUCKET}")
    following = F.lead("at").over(Window.orderBy("at"))
    runs = series.withColumn("at", at).withColumn(
        "until", F.coalesce(following - step, F.col("at"))
    )
    buckets = runs.withColumn("bucket", F.explode(F.sequence("at", "until", step)))
    original = F.col("bucket") == F.col("at")
    return buckets.select(
        *bucket_labels(),
        *[
            (F.when(original, F.col(m)) if m == "ctr" else F.when(original, F.col(m)).otherwise(F.lit(0))).alias(m)
            for m in metrics
        ],
    )


def activity_15min(feed: DataFrame, as_of_ts: datetime, fill: bool = False) -> DataFrame:
    """The series the alert check looks at: yesterday and today up to the last closed bucket.

    Buckets without events are absent unless ``fill`` is set.
    """
    series = activity_series(feed, *closed_span(as_of_ts))
    return (fill_gaps(series) if fill else series).orderBy("date", "minutes")


#: What is added up for each user and bucket, so that both services need no join.
USER_SUMS = ("feed_events", "likes", "views", "messages_sent")


def feed_rows(feed: DataFrame) -> DataFrame:
    """(time, user_id, sums): a row for each feed action."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return feed.select(
        "time",
        "user_id",
        one.alias("feed_events"),
        is_like().cast("long").alias("likes"),
        is_view().cast("long").alias("views"),
        none.alias("messages_sent"),
    )


def message_rows(msg: DataFrame) -> DataFrame:
    """(time, user_id, sums): a row for each message."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return msg.select(
        "time",
        "user_id",
        none.alias("feed_events"),
        none.alias("likes"),
        none.alias("views"),
        one.alias("messages_sent"),
    )


def full_metrics() -> list[Column]:
    """The aggregates of a bucket, over its users' sums; CTR follows from likes and views."""
    known = F.col("user_id").isNotNull()
    return [
        F.count_if(known & (F.col("feed_events") > 0)).alias("dau"),
        total("likes"),
        total("views"),
        F.count_if(known & (F.col("messages_sent") > 0)).alias("message_users"),
        total("messages_sent"),
    ]


def full_columns() -> list[Column]:
    return [F.col(c) if c != "ctr" else ctr_percent() for c in ALL_METRICS]


def activity_15min_full(feed: DataFrame, msg: DataFrame, as_of_ts: datetime, fill: bool = False) -> DataFrame:
    """As ``activity_15min`` with CTR, messenger users and messages sent.

    Both services are reduced to (bucket, user) together, which makes the full
    outer join of their buckets unnecessary.
    """
    span = closed_span(as_of_ts)
    series = full_series(time_span(feed, *span), time_span(msg, *span))
    return (fill_gaps(series, ALL_METRICS) if fill else series).orderBy("date", "minutes")


def full_series(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """All six metrics of every bucket that has events of either service."""
    rows = feed_rows(feed).unionByName(message_rows(msg))
    by_user = rows.groupBy(bucket_start(), "user_id").agg(*[total(name) for name in USER_SUMS])
    by_bucket = by_user.groupBy("bucket").agg(*full_metrics())
    return by_bucket.select(*bucket_labels(), *full_columns())


def _series_order() -> WindowSpec:
    # One partition per metric: its rows are buckets (96 a day), never events.
    return Window.partitionBy("metric").orderBy("date", "minutes")


def _quartiles(series: DataFrame, metrics: Sequence[str], a: float, n: int) -> DataFrame:
    """One row per bucket and metric with the quartiles of the n buckets before it."""
    values = series.select("date", "minutes", *[F.col(m).cast("double") for m in metrics])
    rows = values.unpivot(["date", "minutes"], list(metrics), "metric", "value")
    before = _series_order().rowsBetween(-n, -1)
    full = F.count("value").over(before) == n

    def quantile(q: float) -> Column:
        return F.when(full, F.percentile("value", F.lit(q)).over(before))

    return (
        rows.withColumns({"q25": quantile(0.25), "q75": quantile(0.75)})
        .withColumn("range", F.col("q75") - F.col("q25"))
        .withColumns(
            {
                "low": F.col("q25") - a * F.col("range"),
                "high": F.col("q75") + a * F.col("range"),
            }
        )
    )


def _smooth(rows: DataFrame, first: int, last: int) -> DataFrame:
    frame = _series_order().rowsBetween(first, last)
    return rows.withColumns({c: F.avg(c).over(frame) for c in ("low", "high")})


def _outside() -> Column:
    """Strictly outside the band; False while there is no band yet."""
    outside = (F.col("value") > F.col("high")) | (F.col("value") < F.col("low"))
    return F.coalesce(outside, F.lit(False))


def _with_previous(rows: DataFrame) -> DataFrame:
    previous = F.lag("value").over(_series_order())
    return rows.withColumn("previous", previous).withColumn(
        "deviation", pct_change(F.col("value"), F.col("previous"), 2)
    )


def iqr_bands(
    series: DataFrame, metrics: Sequence[str] = FEED_METRICS, a: float = 4, n: int = 6
) -> DataFrame:
    """Band per metric and bucket, for charts.

    q25/q75 are taken over the previous n rows (NULL until there are n); the
    bounds q25 - a*range and q75 + a*range are then averaged over the n rows
    around each bucket.
    """
    return _smooth(_quartiles(series, metrics, a, n), -(n // 2), (n - 1) // 2)


def anomaly_alerts(bands: DataFrame, flagged_only: bool = True) -> DataFrame:
    """The last bucket of each metric, if it lies outside its band.

    ``flagged_only=False`` keeps the metrics that are within their band.
    """
    columns = ["date", "minutes", "value", "previous", "deviation", "low", "high", "is_alert"]
    checked = _with_previous(bands).withColumn("is_alert", _outside())
    last = checked.groupBy("metric").agg(
        F.max_by(F.struct(*columns), F.struct("date", "minutes")).alias("last")
    )
    rows = last.select("metric", *[F.col(f"last.{name}") for name in columns])
    return rows.where("is_alert") if flagged_only else rows


def anomaly_backtest(
    series: DataFrame, metrics: Sequence[str] = FEED_METRICS, a: float = 4, n: int = 6
) -> DataFrame:
    """What the alert check would have said at every bucket of the series.

    When a bucket is the newest one, the rows after it do not exist yet, so its
    bounds are averaged over that row and the n//2 before it.
    """
    rows = _smooth(_quartiles(series, metrics, a, n), -(n // 2), 0)
    checked = _with_previous(rows).withColumn("is_alert", _outside())
    return checked.select(
        "metric", "date", "minutes", "value", "previous", "deviation", "low", "high", "is_alert"
    )


def context_rows(n: int = 6) -> int:
    """How many earlier buckets a decision depends on."""
    return n + n // 2

