"""Weekly status and retention from a kept bitmap of users' active weeks.

The state has a row for each user, source and block of 64 weeks, with a bit for each
week. A week's events are or-ed into its block, so history is neither read nor written
again; which weeks follow each other, and which was a user's first, are bit
operations on whole blocks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedpulse.functions.dates import days, monday_of, on_days
from feedpulse.sources import versions

#: The Monday that week 0 begins with.
EPOCH = date(1970, 1, 5)
WEEKS = 64

STATE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("weeks", T.LongType()),
    ]
)


def week_number(day: date) -> int:
    return (monday_of(day) - EPOCH).days // 7


def _week() -> Column:
    """The number of an event's week."""
    return F.floor(F.datediff(F.to_date("time"), F.lit(EPOCH)) / 7).cast("int")


def week_bits(feed: DataFrame) -> DataFrame:
    """The state that ``feed``'s events alone make. Events without a user or a time are left out."""
    week = _week()
    bit = F.expr(f"shiftleft(1L, pmod(week, {WEEKS}))")
    known = F.col("user_id").isNotNull() & F.col("time").isNotNull()
    marked = feed.where(known).select("user_id", "source", week.alias("week"))
    return marked.groupBy("user_id", "source", F.floor(F.col("week") / WEEKS).cast("int").alias("block")).agg(
        F.bit_or(bit).alias("weeks")
    )


def merged(state: DataFrame, more: DataFrame) -> DataFrame:
    """Both states in one. The order of merging does not matter, nor does merging the same events twice."""
    rows = state.unionByName(more)
    return rows.groupBy("user_id", "source", "block").agg(F.bit_or("weeks").alias("weeks"))


def extend(feed: DataFrame, path: str, first: date, last: date) -> None:
    """Bring the weeks of the days first..last into the state kept under ``path``.

    Only these weeks' events are read, whole weeks, and only their blocks are replaced, at once.
    Late events of a past week are brought in by extending by that week again.
    """
    spark = feed.sparkSession
    start, end = monday_of(first), monday_of(last) + days(6)
    new = week_bits(on_days(feed, start, end))
    blocks = range(week_number(first) // WEEKS, week_number(last) // WEEKS + 1)
    known = versions.parts(spark, path)
    changed = {}
    for block in blocks:
        rows = new.where(F.col("block") == block)
        if str(block) in known:
            rows = merged(versions.read(spark, path, STATE, [str(block)]), rows)
        changed[str(block)] = rows
    versions.replace(path, changed)


def read_state(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The kept state; with ``since``, without the blocks that end before its week."""
    wanted = None
    if since is not None:
        first = week_number(since) // WEEKS
        wanted = sorted((b for b in versions.parts(spark, path) if int(b) >= first), key=int)
    return versions.read(spark, path, STATE, wanted)


def _weeks_of(bits: Column) -> Column:
    """Positions of the bits that are set."""
    places = F.sequence(F.lit(0), F.lit(WEEKS - 1))
    return F.filter(places, lambda i: F.getbit(bits, i) == 1)


def _monday(block: Column, place: Column) -> Column:
    return F.date_add(F.lit(EPOCH), ((block * WEEKS + place) * 7).cast("int"))


def activity_status(state: DataFrame, as_of: date, since: date | None = None) -> DataFrame:
    """What ``retention.weekly_activity_status`` says, from the state; with ``since``, from that week on.

    A week's bits beside those of the week before are one shift; the last week of a block
    is carried into the next, also into one the user has no row in. ``since`` needs the block
    of the week before it in ``state``.
    """
    own = state.groupBy("user_id", "block").agg(F.bit_or("weeks").alias("weeks"))
    carried = F.struct((F.col("block") + 1).alias("block"), F.lit(0).cast("long").alias("weeks"), F.lit(1).alias("last"))
    here = F.struct("block", "weeks", F.lit(0).alias("last"))
    ends = F.getbit("weeks", F.lit(WEEKS - 1)) == 1
    rows = own.select("user_id", F.inline(F.when(ends, F.array(here, carried)).otherwise(F.array(here))))
    blocks = rows.groupBy("user_id", "block").agg(
        F.bit_or("weeks").alias("weeks"), F.max("last").cast("long").alias("last")
    )
    before = F.shiftleft("weeks", 1).bitwiseOR(F.col("last"))
    active = F.col("weeks")
    kinds = F.array(
        F.struct(F.lit("retained").alias("status"), active.bitwiseAND(before).alias("bits")),
        F.struct(F.lit("new").alias("status"), active.bitwiseAND(F.bitwise_not(before)).alias("bits")),
        F.struct(F.lit("gone").alias("status"), before.bitwiseAND(F.bitwise_not(active)).alias("bits")),
    )
    marks = blocks.select("block", F.inline(kinds)).select("block", "status", F.explode(_weeks_of(F.col("bits"))).alias("place"))
    counts = marks.groupBy("block", "place", "status").agg(F.count("*").alias("n"))
    gone = F.col("status") == "gone"
    result = counts.select(
        _monday(F.col("block"), F.col("place")).alias("week"),
        "status",
        F.when(gone, -F.col("n")).otherwise(F.col("n")).alias("num_users"),
    ).where(~(gone & (F.col("week") == F.lit(monday_of(as_of) + days(7)))))
    if since is not None:
        result = result.where(F.col("week") >= F.lit(monday_of(since)))
    return result.orderBy(F.desc("num_users"), "week", "status")


def cohort_sizes(state: DataFrame, source: str) -> DataFrame:
    """What ``retention.weekly_retention`` says, from the state.

    A user's first week is the lowest bit of the first block. The window has a row for each
    of a user's blocks, one in 64 weeks.
    """
    bits = F.col("weeks")
    # The bits below the lowest one, counted.
    lowest = F.bit_count(bits.bitwiseAND(-bits) - F.lit(1).cast("long"))
    in_block = F.when(bits == F.lit(-(1 << 63)), F.lit(WEEKS - 1)).otherwise(lowest)
    first = F.min(F.col("block") * WEEKS + in_block).over(Window.partitionBy("user_id"))
    rows = state.where(F.col("source") == source).select("block", "weeks", first.alias("first"))
    counts = (
        rows.select("first", "block", F.explode(_weeks_of(bits)).alias("place"))
        .groupBy("first", "block", "place")
        .agg(F.count("*").alias("rt"))
    )
    first_monday = _monday(F.lit(0), F.col("first"))
    number = (F.col("block") * WEEKS + F.col("place") - F.col("first")).cast("long")
    return counts.select(
        first_monday.alias("first_action"),
        _monday(F.col("block"), F.col("place")).alias("action"),
        number.alias("week_number"),
        "rt",
    ).orderBy("first_action", "action")
