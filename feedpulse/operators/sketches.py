"""Kept sketches: distinct users and quantiles by day, put together for any window.

A day's sketch has a bounded size, however many users there were. Sketches of several
days are united without going back to the events, in any order; the exact counterparts
in this package read the events of the whole window.

Theta sketches tell set operations apart from counts (users of both weeks, of one
only); HLL sketches are smaller and only count. Both hold up to about 2^lg_k users
exactly; beyond, the relative error of a union has the standard deviation of
``relative_error``, and that of an intersection or difference is relative to the union.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.functions.dates import days, event_day, monday, monday_of

LG_K = 12
SIGMAS = 4
KLL_K = 400

_DISTINCT = {
    "theta": (F.theta_sketch_agg, F.theta_union_agg, F.theta_sketch_estimate),
    "hll": (F.hll_sketch_agg, F.hll_union_agg, F.hll_sketch_estimate),
}


def relative_error(lg_k: int = LG_K, kind: str = "theta") -> float:
    """The standard deviation of an estimate, as a share of the number of users."""
    return {"theta": 1.0, "hll": 1.04}[kind] / math.sqrt(2**lg_k - 1)


def within(estimate: Column, exact: Column, base: Column, lg_k: int = LG_K, kind: str = "theta") -> Column:
    """Whether an estimate is as near as stated: ``SIGMAS`` deviations of ``base``, the size of the union."""
    return F.abs(estimate - exact) <= SIGMAS * relative_error(lg_k, kind) * base


# Distinct users


def dimension_rows(actions: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """(date, dimension, dimension_value, user_id): each action in total and for each dimension, missing as ``unknown``."""
    pairs = [F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("dimension_value"))]
    for name in dimensions:
        value = F.coalesce(F.col(name).cast("string"), F.lit("unknown"))
        pairs.append(F.struct(F.lit(name).alias("dimension"), value.alias("dimension_value")))
    known = actions.where(F.col("user_id").isNotNull())
    return known.select(event_day().alias("date"), F.inline(F.array(*pairs)), "user_id")


KEYS = ("date", "dimension", "dimension_value")


def daily_sketches(
    actions: DataFrame, dimensions: Sequence[str] = ("os", "source"), lg_k: int = LG_K, kind: str = "theta"
) -> DataFrame:
    """(date, dimension, dimension_value, users): a sketch of each day's users, in total and by dimension.

    Sketches are begun in each task, so a day or value with most events shuffles no more than others.
    """
    make, _, _ = _DISTINCT[kind]
    return dimension_rows(actions, dimensions).groupBy(*KEYS).agg(make("user_id", F.lit(lg_k)).alias("users"))


def united(sketches: DataFrame, *keys: str, lg_k: int = LG_K, kind: str = "theta") -> DataFrame:
    """One sketch for each value of ``keys``, of all that fall there: days, values, services."""
    _, union, _ = _DISTINCT[kind]
    size = {"theta": (F.lit(lg_k),), "hll": ()}[kind]
    return sketches.groupBy(*keys).agg(union("users", *size).alias("users"))


def users_in_window(
    sketches: DataFrame, n: int = 7, step: int = 1, lg_k: int = LG_K, kind: str = "theta"
) -> DataFrame:
    """(date, dimension, dimension_value, estimate): users of the ``n`` days up to each ``step``-th day there is data for.

    Every day's sketch goes to the windows it is in, at most ``n``; no window reads events.
    """
    _, _, estimate = _DISTINCT[kind]
    last = sketches.agg(F.max("date")).scalar()
    ends = F.sequence(F.lit(0), F.lit(n - 1))
    shifted = sketches.select(
        F.explode(F.transform(ends, lambda i: F.date_add("date", i))).alias("date"), *KEYS[1:], "users"
    )
    inside = shifted.where((F.col("date") <= last) & (F.datediff(last, "date") % step == 0))
    return united(inside, *KEYS, lg_k=lg_k, kind=kind).select(*KEYS, estimate("users").alias("estimate"))


def exact_users_in_window(actions: DataFrame, dimensions: Sequence[str], n: int = 7) -> DataFrame:
    """What ``users_in_window`` estimates, by counting: each user's day goes to ``n`` windows."""
    rows = dimension_rows(actions, dimensions).distinct()
    last = rows.agg(F.max("date")).scalar()
    shifted = rows.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.date_add("date", i))).alias("date"),
        *KEYS[1:],
        "user_id",
    )
    inside = shifted.distinct().where(F.col("date") <= last)
    return inside.groupBy(*KEYS).agg(F.count("*").alias("users"))


def weekly_status_estimate(sketches: DataFrame, as_of: date, lg_k: int = LG_K) -> DataFrame:
    """(week, status, num_users, active): ``weekly_activity_status`` from daily theta sketches alone.

    Users of both weeks are an intersection, new and gone ones the two differences. ``active`` is
    the estimated union of the two weeks, which the error is relative to. There is no row
    for the week after the current one.
    """
    total = sketches.where("dimension = 'all'").withColumn("week", monday(F.col("date")))
    weeks = united(total, "week", lg_k=lg_k)
    none = F.lit(None).cast("binary")
    marks = weeks.select(
        F.inline(
            F.array(
                F.struct("week", F.col("users").alias("now"), none.alias("before")),
                F.struct(F.date_add("week", 7).alias("week"), none.alias("now"), F.col("users").alias("before")),
            )
        )
    )
    # At most two rows a week.
    pairs = marks.groupBy("week").agg(
        F.max_by("now", F.col("now").isNotNull()).alias("now"), F.max_by("before", F.col("before").isNotNull()).alias("before")
    )
    size = lambda sketch: F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")
    both = F.theta_intersection("now", "before")
    new = F.when(F.col("before").isNull(), F.col("now")).otherwise(F.theta_difference("now", "before"))
    gone = F.when(F.col("now").isNull(), F.col("before")).otherwise(F.theta_difference("before", "now"))
    either = F.theta_union(F.coalesce("now", "before"), F.coalesce("before", "now"), F.lit(lg_k))
    kinds = F.array(
        F.struct(F.lit("retained").alias("status"), size(both).alias("num_users")),
        F.struct(F.lit("new").alias("status"), size(new).alias("num_users")),
        F.struct(F.lit("gone").alias("status"), (-size(gone)).alias("num_users")),
    )
    rows = pairs.select("week", F.inline(kinds), size(either).alias("active"))
    shown = rows.select("week", "status", "num_users", "active").where("num_users <> 0")
    coming = (F.col("status") == "gone") & (F.col("week") == F.lit(monday_of(as_of) + days(7)))
    return shown.where(~coming)


# Quantiles


def rank_error(k: int = KLL_K) -> float:
    """How far a KLL quantile's rank is from the asked one at most, with 99 %, as a share of the values."""
    return 2.296 / k**0.9021


def daily_quantile_sketches(values: DataFrame, value: str, *keys: str, k: int = KLL_K) -> DataFrame:
    """A KLL sketch of ``value`` for each value of ``keys``, with the number of values; NULL is left out."""
    known = values.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"), F.count("*").alias("n")
    )


def quantiles(sketches: DataFrame, probabilities: Sequence[float], *keys: str, k: int = KLL_K) -> DataFrame:
    """(keys, n, p, quantile): quantiles of all values in the sketches that fall together."""
    merged = sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n")
    )
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.kll_sketch_get_quantile_double("sketch", asked)
    pairs = F.zip_with(asked, found, lambda p, q: F.struct(p.alias("p"), q.alias("quantile")))
    return merged.select(*keys, "n", F.inline(pairs))


def equal_bins(sketches: DataFrame, bins: int, *keys: str, k: int = KLL_K) -> DataFrame:
    """(keys, bin, low, high): bounds of ``bins`` bins with about as many values each, without sorting the values."""
    edges = quantiles(sketches, [i / bins for i in range(bins + 1)], *keys, k=k)
    bounds = edges.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("p", "quantile"))).alias("edges"))
    places = F.sequence(F.lit(0), F.lit(bins - 1))
    one = F.transform(
        places,
        lambda i: F.struct(
            i.alias("bin"), F.get("edges", i)["quantile"].alias("low"), F.get("edges", i + 1)["quantile"].alias("high")
        ),
    )
    return bounds.select(*keys, F.inline(one))


def rank_of(values: DataFrame, value: str, asked: DataFrame, *keys: str) -> DataFrame:
    """``asked`` (keys, p, quantile) with the exact share of values below it and up to it: the check of a sketch."""
    joined = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v")).join(
        F.broadcast(asked), list(keys)
    )
    return joined.groupBy(*keys, "p", "quantile").agg(
        (F.count_if(F.col("v") < F.col("quantile")) / F.count("*")).alias("below"),
        (F.count_if(F.col("v") <= F.col("quantile")) / F.count("*")).alias("up_to"),
    )
