"""Counts, ratios and changes."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def is_like() -> Column:
    return F.col("action") == "like"


def is_view() -> Column:
    return F.col("action") == "view"


def likes() -> Column:
    return F.count_if(is_like()).alias("likes")


def views() -> Column:
    return F.count_if(is_view()).alias("views")


def total(column: str) -> Column:
    """Sum that is 0 instead of NULL when there is nothing to add."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(column)


def ratio(a: Column, b: Column) -> Column:
    """a / b as DOUBLE, NULL where b is 0."""
    return F.try_divide(a, b)


def ctr_percent() -> Column:
    return F.round(ratio(F.col("likes"), F.col("views")) * 100, 2).alias("ctr")


def share_percent(part: Column, other: Column, digits: int) -> Column:
    """part as a percentage of part + other."""
    return F.round(ratio(part, part + other) * 100, digits)


def pct_change(current: Column, previous: Column, digits: int) -> Column:
    """Change against the previous value in percent; NULL where there is none or it is 0."""
    return F.round(ratio(current - previous, previous) * 100, digits)


def previous_by_date(value: Column) -> Column:
    """The last non-NULL value on an earlier date.

    The window has no partition key, so it may only be used on frames that are
    already down to one row per day.
    """
    earlier = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(earlier)
