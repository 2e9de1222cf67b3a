"""A Poisson bootstrap that grows with its experiment: sums of each replicate kept by day.

The weight of a user in a replicate depends on nothing but the user, so a replicate's
weighted likes and views are sums over days. Yesterday's events make yesterday's
sums, and an experiment of any length, or any part of it, is put together from the kept
ones without its events.

Users are dealt to ``UNITS`` units by a hash, and a unit's users share their weights. Units
are as independent as users are, so the spread between replicates estimates the same; a day
costs units times replicates, however many users there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.dates import days, event_day, on_days
from feedpulse.functions.draws import poisson
from feedpulse.functions.measures import likes, ratio, views
from feedpulse.sources import versions

UNITS, REPS, SEED = 4_096, 2_000, 42
DAY_SUMS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("replicate", T.IntegerType()),
        T.StructField("exp_group", T.IntegerType()),
        T.StructField("likes", T.LongType()),
        T.StructField("views", T.LongType()),
    ]
)


def _digits(text: Column, n: int) -> Column:
    """The first ``n`` hexadecimal digits of the MD5 sum as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, n), 16, 10).cast("long")


def unit_of(user: Column, units: int = UNITS) -> Column:
    return _digits(user.cast("string"), 8) % units


def weight(unit: Column, replicate: Column, seed: int = SEED) -> Column:
    """Poisson(1), from 52 bits of a hash of seed, unit and replicate."""
    u = _digits(F.concat_ws(":", F.lit(seed), unit, replicate), 13).cast("double") * F.lit(2.0**-52)
    return poisson(u, 1)


def day_sums(
    feed: DataFrame,
    first: date,
    last: date,
    groups: Sequence[int],
    reps: int = REPS,
    seed: int = SEED,
    units: int = UNITS,
) -> DataFrame:
    """(date, replicate, exp_group, likes, views) of the days first..last; events without a user are left out.

    Events are added up by unit in each task first; the weighted rows exist only inside the map side of the second
    aggregation, which all tasks share.
    """
    events = on_days(feed, first, last).where(F.col("user_id").isNotNull() & F.col("exp_group").isin(list(groups)))
    by_unit = events.groupBy(
        event_day().alias("date"), F.col("exp_group").cast("int").alias("exp_group"), unit_of(F.col("user_id"), units).alias("unit")
    ).agg(likes(), views())
    slots = int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = by_unit.repartition(slots, "date", "exp_group", "unit")
    replicates = F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("replicate")
    weighted = spread.select("date", "exp_group", "likes", "views", "unit", replicates).withColumn(
        "w", weight(F.col("unit"), F.col("replicate"), seed)
    )
    sums = [F.sum(F.col("w") * F.col(c)).alias(c) for c in ("likes", "views")]
    return weighted.groupBy("date", "replicate", "exp_group").agg(*sums).select(*DAY_SUMS.fieldNames())


def keep_days(
    feed: DataFrame, path: str, first: date, last: date, groups: Sequence[int], reps: int = REPS, seed: int = SEED
) -> None:
    """Store the sums of the days first..last under ``path``, replacing these days at once.

    Only their events are read; a day is done anew by keeping it again. All days of a path need the same
    groups, replicates and seed.
    """
    sums = day_sums(feed, first, last, groups, reps, seed).persist()
    try:
        wanted = [first + days(n) for n in range((last - first).days + 1)]
        versions.replace(path, {d.isoformat(): sums.where(F.col("date") == F.lit(d)).coalesce(1) for d in wanted})
    finally:
        sums.unpersist()


def bootstrap(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """(replicate, exp_group, ctr) of the kept days first..last, as ``experiments.poisson_bootstrap`` has it.

    ``experiments.bootstrap_summary`` takes it from there. A day that is not kept is an error.
    """
    wanted = [(first + days(n)).isoformat() for n in range((last - first).days + 1)]
    if missing := sorted(set(wanted) - set(versions.parts(spark, path))):
        raise ValueError(f"{path} lacks the days {missing}")
    sums = versions.read(spark, path, DAY_SUMS, wanted).groupBy("replicate", "exp_group")
    both = sums.agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    return both.select("replicate", "exp_group", ratio(F.col("likes"), F.col("views")).alias("ctr"))
