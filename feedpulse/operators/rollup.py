"""Daily roll-up of feed and messenger activity by user dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, event_day, on_days
from feedpulse.functions.demographics import FEMALE, UNDER_25, age_group, gender_label
from feedpulse.functions.measures import likes, total, views
from feedpulse.sources.schema import DAILY_ROLLUP, ROLLUP_METRICS

DIMENSIONS = ("gender", "age_group", "os")
MESSAGE_METRICS = ["messages_sent", "users_sent", "messages_received", "users_received"]

# Labels of users without feed history: what a server that fills unmatched rows
# with type defaults (gender 0, age 0, empty os) arrives at, or an honest 'unknown'.
UNMATCHED = {
    "defaults": {"gender": FEMALE, "age_group": UNDER_25, "os": ""},
    "unknown": {"gender": "unknown", "age_group": "unknown", "os": "unknown"},
}
# The os of users who have feed history without one: a missing value filled with 0
# before the groups are formed, or 'unknown'. Either way it is a group of its own.
NO_OS = {"defaults": "0", "unknown": "unknown"}


def _yesterday(df: DataFrame, as_of: date) -> DataFrame:
    return on_days(df, as_of - days(1), as_of - days(1))


def user_demographics(df: DataFrame) -> DataFrame:
    """Replace the gender code by its label and add ``age_group``."""
    return df.withColumns({"gender": gender_label(), "age_group": age_group()})


def feed_user_daily(feed: DataFrame, as_of: date) -> DataFrame:
    """Likes and views of the day before ``as_of`` per user and dimension."""
    day = user_demographics(_yesterday(feed, as_of))
    return day.groupBy("user_id", *DIMENSIONS).agg(likes(), views())


def message_user_daily(msg: DataFrame, as_of: date) -> DataFrame:
    """Messages sent and received on the day before ``as_of``, and with how many users.

    The day is first reduced to one row per (sender, receiver). Each such pair
    counts once for either end, so both sides come out of a single aggregation
    and no join of senders with receivers is needed.
    """
    pairs = _yesterday(msg, as_of).groupBy("user_id", "receiver_id").agg(F.count("*").alias("n"))
    none = F.lit(0).cast("long")
    known = {c: F.col(c).isNotNull().cast("long") for c in ("user_id", "receiver_id")}

    def end(user: str, sent, users_sent, received, users_received):
        values = zip(MESSAGE_METRICS, (sent, users_sent, received, users_received))
        return F.struct(F.col(user).alias("user_id"), *[v.alias(name) for name, v in values])

    ends = pairs.select(
        F.inline(
            F.array(
                end("user_id", F.col("n"), known["receiver_id"], none, none),
                end("receiver_id", none, none, F.col("n"), known["user_id"]),
            )
        )
    )
    return ends.groupBy("user_id").agg(*[total(name) for name in MESSAGE_METRICS])


def user_dims(feed: DataFrame, dims: str = "all") -> DataFrame:
    """The dimension values each user has been seen with.

    ``all`` keeps every combination in the history, so a user whose attribute
    changed has several rows; ``latest`` keeps the most recent one.
    """
    labelled = user_demographics(feed)
    if dims == "all":
        return labelled.select("user_id", *DIMENSIONS).distinct()
    if dims == "latest":
        last = F.max(F.struct("time", *DIMENSIONS)).alias("last")
        by_user = labelled.groupBy("user_id").agg(last)
        return by_user.select("user_id", *[F.col(f"last.{name}") for name in DIMENSIONS])
    raise ValueError(f"unknown dims {dims!r}; use 'all' or 'latest'")


def dims_with_day(kept: DataFrame | None, feed: DataFrame, first: date | None, last: date) -> DataFrame:
    """Kept dimension values with those of the days first..last: one row per user and combination.

    ``first_day`` tells when a combination was first seen.
    """
    labelled = user_demographics(on_days(feed, first, last))
    new = labelled.groupBy("user_id", *DIMENSIONS).agg(F.min(event_day()).alias("first_day"))
    if kept is None:
        return new
    both = kept.select(*new.columns).unionByName(new)
    return both.groupBy("user_id", *DIMENSIONS).agg(F.min("first_day").alias("first_day"))


def message_user_dims(
    msg_daily: DataFrame,
    feed: DataFrame,
    unmatched: str = "defaults",
    dims: str = "all",
    known_dims: DataFrame | None = None,
) -> DataFrame:
    """Attach the dimensions found in the whole feed history to per-user message counts.

    With ``dims='all'`` a user with several combinations appears once for each of
    them, and their messages count once for each. The history is reduced to
    distinct combinations before the join, so no user can bring more rows into
    it than they have combinations, however many events they have. ``known_dims``,
    with one row per user and combination, takes the place of reading the history.
    """
    known = user_dims(feed, dims) if known_dims is None else known_dims
    joined = msg_daily.join(known, "user_id", "left")
    # The labels are never NULL for a matched user, os may be.
    absent = F.col("gender").isNull()
    filled = {
        name: F.when(absent, F.lit(label)).otherwise(F.col(name))
        for name, label in UNMATCHED[unmatched].items()
    }
    return joined.withColumns(filled)


def _stack(feed_part: DataFrame, msg_part: DataFrame, unmatched: str) -> DataFrame:
    stacked = feed_part.unionByName(msg_part, allowMissingColumns=True)
    return stacked.na.fill(0, ROLLUP_METRICS).na.fill(NO_OS[unmatched], ["os"])


def user_daily_merged(
    feed_daily: DataFrame, msg_dims: DataFrame, unmatched: str = "defaults"
) -> DataFrame:
    """All six metrics per (user, dimensions), 0 where a user was absent from a service.

    A missing os becomes ``NO_OS``.

    The inputs hold each key once, so adding up their union equals their full
    outer join with NULLs matching each other, at the price of one shuffle.
    """
    stacked = _stack(feed_daily, msg_dims, unmatched)
    return stacked.groupBy("user_id", *DIMENSIONS).agg(*[total(m) for m in ROLLUP_METRICS])


def dimension_rollup(merged: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Sums of the metrics by each single dimension.

    ``users_sent`` and ``users_received`` are sums over users, not distinct
    counts. Every user counts in every dimension, so all have the same totals.

    The rows are summed to one per combination of values first; only those few
    are then repeated for each dimension.
    """
    cells = merged.groupBy(*dims).agg(*[total(m) for m in ROLLUP_METRICS])
    by_dimension = cells.unpivot(ROLLUP_METRICS, list(dims), "dimension", "dimension_value")
    return (
        by_dimension.groupBy("dimension", "dimension_value")
        .agg(*[total(m) for m in ROLLUP_METRICS])
    )


def daily_rollup_final(
    feed: DataFrame,
    msg: DataFrame,
    as_of: date,
    unmatched: str = "defaults",
    dims: str = "all",
    known_dims: DataFrame | None = None,
) -> DataFrame:
    """The roll-up table's rows for the day before ``as_of``.

    Only sums are wanted, so feed events are added up by dimension straight away
    instead of by user, and the per-user merge of the two services is left out.
    The feed history that messenger users' dimensions come from ends with that day too,
    so that a later rerun gives the same rows.
    """
    feed_part = user_demographics(_yesterday(feed, as_of)).groupBy(*DIMENSIONS).agg(likes(), views())
    msg_daily = message_user_daily(msg, as_of)
    history = on_days(feed, None, as_of - days(1))
    by_user = message_user_dims(msg_daily, history, unmatched, dims, known_dims)
    rows = dimension_rollup(_stack(feed_part, by_user.drop("user_id"), unmatched))
    return rows.withColumn("event_date", F.lit(as_of - days(1))).select(*DAILY_ROLLUP.fieldNames())
