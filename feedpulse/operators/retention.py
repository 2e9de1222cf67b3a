"""Weekly activity status, cohort retention and campaign retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, event_day, monday, monday_of
from feedpulse.functions.measures import ratio

# A user with more than 1/HOT_USERS of all events counts as hot; there can be no
# more than HOT_USERS of them, which bounds what is broadcast for them.
HOT_USERS = 10_000
SALTS = 4_096


def weekly_activity_status(feed: DataFrame, as_of: date, limit: int | None = None) -> DataFrame:
    """Users per Monday-week who are new, retained or gone.

    ``new``: active, but not the week before (so returning users are included);
    ``retained``: active this week and the week before; ``gone``: active the week
    before only, as a negative count. Users cannot be gone in the week after the
    current one yet, so that is left out.

    Every active week also marks the week after it. One aggregation by (user,
    week) then knows both "active" and "active the week before", which takes
    a single shuffle of pre-aggregated rows and neither arrays nor a window.
    """
    week = monday(F.col("time"))
    no, yes = F.lit(False), F.lit(True)

    def mark(at, active, before):
        return F.struct(at.alias("week"), active.alias("active"), before.alias("before"))

    marks = feed.select(
        "user_id", F.inline(F.array(mark(week, yes, no), mark(F.date_add(week, 7), no, yes)))
    )
    user_weeks = marks.groupBy("user_id", "week").agg(
        F.max("active").alias("active"), F.max("before").alias("before")
    )
    status = (
        F.when(F.col("active") & F.col("before"), "retained")
        .when(F.col("active"), "new")
        .otherwise("gone")
    )
    counts = user_weeks.groupBy("week", status.alias("status")).agg(F.count("user_id").alias("n"))
    gone = F.col("status") == "gone"
    next_week = F.lit(monday_of(as_of) + days(7))
    rows = counts.where(~(gone & (F.col("week") == next_week))).select(
        "week", "status", F.when(gone, -F.col("n")).otherwise(F.col("n")).alias("num_users")
    )
    ordered = rows.orderBy(F.desc("num_users"), "week", "status")
    return ordered if limit is None else ordered.limit(limit)


def weekly_retention(feed: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """Users of each weekly cohort active in each later week.

    A cohort is the user's first week within the given source. The history is
    reduced to distinct (user, week) rows first, so the per-user window holds at
    most one row per week, however active the user is.
    """
    weeks = (
        feed.where(F.col("source") == source)
        .select("user_id", monday(F.col("time")).alias("action"))
        .distinct()
    )
    first = F.min("action").over(Window.partitionBy("user_id")).alias("first_action")
    counts = (
        weeks.select("user_id", "action", first)
        .groupBy("first_action", "action")
        .agg(F.count("user_id").alias("rt"))
    )
    week_number = F.expr("datediff(action, first_action) div 7").alias("week_number")
    rows = counts.select("first_action", "action", week_number, "rt")
    ordered = rows.orderBy("first_action", "action")
    return ordered if limit is None else ordered.limit(limit)


def weekly_retention_percent(
    feed: DataFrame, source: str, digits: int = 1, limit: int | None = None
) -> DataFrame:
    """``weekly_retention`` as a percentage of the cohort's largest week."""
    ordered = as_percent(weekly_retention(feed, source), digits)
    return ordered if limit is None else ordered.limit(limit)


def as_percent(counts: DataFrame, digits: int = 1) -> DataFrame:
    """Cohort sizes as a percentage of the cohort's largest week."""
    largest = F.max("rt").over(Window.partitionBy("first_action"))
    percent = F.round(ratio(F.col("rt") * 100, largest), digits).alias("percent_rt")
    rows = counts.select("first_action", "action", "week_number", percent)
    return rows.orderBy("first_action", "action")


def first_action_date(feed: DataFrame, hot_users: int = HOT_USERS, salts: int = SALTS) -> DataFrame:
    """Every event with its user's first active date over all sources.

    First dates are aggregated per user and joined back to the events. Users that
    hold more than 1/``hot_users`` of all events with a user get theirs from a broadcast of
    at most ``hot_users`` rows, and their events are spread over ``salts`` (a power
    of two) join keys instead of meeting in one task. Hot and other users come out of
    the same aggregation, which Spark runs once.
    """
    events = feed.select("user_id", event_day().alias("action_time"), "source", "time")
    firsts = events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("action_time").alias("first_action"), F.count("*").alias("events")
    )
    all_events = firsts.agg(F.sum("events")).scalar()
    hot = firsts.where(F.col("events") * hot_users > all_events).select(
        "user_id", F.col("first_action").alias("hot_first")
    )
    # The join key is one column, of user and salt: with two, Spark would reuse the
    # partitioning by user alone that the aggregation leaves behind, and a constant salt
    # would be optimized away. Either way a hot user's events would meet in one task.
    def slot(*salted_by: str) -> Column:
        return F.struct("user_id", F.xxhash64(*salted_by).bitwiseAND(F.lit(salts - 1)).alias("salt"))

    others = firsts.where(F.col("events") * hot_users <= all_events).select(
        slot("user_id").alias("slot"), "first_action"
    )
    is_hot = F.col("hot_first").isNotNull()
    salted = events.join(F.broadcast(hot), "user_id", "left").withColumn(
        "slot", F.when(is_hot, slot("time", "source")).otherwise(slot("user_id"))
    )
    return salted.join(others, "slot", "left").select(
        "user_id",
        "action_time",
        "source",
        F.coalesce("hot_first", "first_action").alias("first_action"),
    )


def _cohort_days(feed: DataFrame, first: date, last: date) -> DataFrame:
    """Distinct (user, source, day) of the users whose first day lies in first..last."""
    user_days = feed.select("user_id", "source", event_day().alias("action_time")).distinct()
    first_action = F.min("action_time").over(Window.partitionBy("user_id"))
    return user_days.withColumn("first_action", first_action).where(
        F.col("first_action").between(F.lit(first), F.lit(last))
    )


def campaign_daily_retention(feed: DataFrame, cohort_date: date) -> DataFrame:
    """Users of one day's cohort active on each day, per source."""
    return (
        _cohort_days(feed, cohort_date, cohort_date)
        .groupBy("source", "first_action", "action_time")
        .agg(F.count("user_id").alias("retention"))
    )


def campaign_retention_share(retention: DataFrame) -> DataFrame:
    """Add the percentage of the source's largest day."""
    largest = F.max("retention").over(Window.partitionBy("source"))
    share = F.round(ratio(F.col("retention") * 100, largest), 2)
    return retention.withColumn("retention_share", share)


def campaign_vs_neighbours(feed: DataFrame, cohort_date: date, days_around: int = 3) -> DataFrame:
    """The campaign day's cohort beside those of the days around it.

    ``day_number`` counts from each cohort's first day; the share is of the
    cohort's largest day within the source.
    """
    around = days(days_around)
    counts = (
        _cohort_days(feed, cohort_date - around, cohort_date + around)
        .groupBy("source", "first_action", "action_time")
        .agg(F.count("user_id").alias("retention"))
    )
    largest = F.max("retention").over(Window.partitionBy("source", "first_action"))
    return counts.select(
        "source",
        "first_action",
        F.datediff("action_time", "first_action").alias("day_number"),
        "retention",
        F.round(ratio(F.col("retention") * 100, largest), 2).alias("retention_share"),
    )
