"""Date ranges and calendar columns.

Ranges are written as plain comparisons on ``time`` so that they reach the
Parquet scan. A table laid out by day (column ``event_date``) is also filtered
on that column, which skips the other days' files altogether.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_PARTITION = "event_date"
#: Spans of days that a condition is made of at most.
SPANS = 4


def days(n: int) -> timedelta:
    return timedelta(days=n)


def event_day() -> Column:
    return F.to_date("time")


def monday(column: Column) -> Column:
    """First day of the ISO week."""
    return F.to_date(F.date_trunc("week", column))


def monday_of(day: date) -> date:
    return day - days(day.weekday())


def midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def time_span(df: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with start <= time < end; either side may be open."""
    kind = df.schema["time"].dataType
    if start is not None:
        df = df.where(F.col("time") >= F.lit(start.isoformat(" ")).cast(kind))
    if end is not None:
        df = df.where(F.col("time") < F.lit(end.isoformat(" ")).cast(kind))
    if DAY_PARTITION in df.columns:
        if start is not None:
            df = df.where(F.col(DAY_PARTITION) >= F.lit(start.date()))
        if end is not None:
            df = df.where(F.col(DAY_PARTITION) <= F.lit(end.date()))
    return df


def on_days(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Rows of the days first..last, both included; either side may be open."""
    return time_span(
        df,
        None if first is None else midnight(first),
        None if last is None else midnight(last + days(1)),
    )


def spans(wanted: Iterable[date], most: int = SPANS) -> list[tuple[date, date]]:
    """(first, last) of the runs of days, in order; beyond ``most`` the closest ones are joined."""
    ordered = sorted(set(wanted))
    gaps = [(b - a, at) for at, (a, b) in enumerate(zip(ordered, ordered[1:]), 1) if b - a > days(1)]
    starts = sorted(at for _, at in sorted(gaps, reverse=True)[: most - 1])
    return [(ordered[i], ordered[j - 1]) for i, j in zip([0, *starts], [*starts, len(ordered)])] if ordered else []


def on_any_day(df: DataFrame, *wanted: date) -> DataFrame:
    """Rows of the given days, read in one scan.

    The scan is told a few spans of days, however many days there are. Where these hold
    other days too, the rows' days are looked up in the set of those wanted.
    """
    kind = df.schema["time"].dataType

    def at(day: date) -> Column:
        return F.lit(midnight(day).isoformat(" ")).cast(kind)

    told = spans(wanted)
    within = F.lit(False)
    for first, last in told:
        within = within | ((F.col("time") >= at(first)) & (F.col("time") < at(last + days(1))))
    df = df.where(within)
    if sum((last - first).days + 1 for first, last in told) > len(set(wanted)):
        df = df.where(event_day().isin(list(wanted)))
    if DAY_PARTITION in df.columns:
        df = df.where(F.col(DAY_PARTITION).isin(list(wanted)))
    return df


def last_days(df: DataFrame, as_of: date, n: int = 7) -> DataFrame:
    """The n full days before ``as_of``."""
    return on_days(df, as_of - days(n), as_of - days(1))
