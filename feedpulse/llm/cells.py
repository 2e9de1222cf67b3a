"""Dealing residents and visitors of buckets to tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(visits: DataFrame, bucket: list[str], item: str, size: int) -> DataFrame:
    """``visits`` with ``r``, ``v``: a bucket's rows dealt to a grid of cells.

    ``visits`` has a row for each item and bucket it goes to; ``resident`` tells
    whether it lives there. A resident gets a row of the grid by a hash of
    ``item``, and is copied along it; every item as a visitor gets a column, and
    is copied along that. So each resident meets each visitor in one cell, and a
    cell has about ``size`` of either. Only buckets with more rows than ``size``
    have a grid beyond one cell.
    """
    counts = (
        visits.groupBy(*bucket)
        .agg(F.count("*").alias("n"), F.count_if("resident").alias("residents"))
        .where(f"n > {size}")
        .select(
            *bucket,
            F.greatest(F.ceil(F.col("residents") / size), F.lit(1)).cast("int").alias("rows"),
            F.ceil(F.col("n") / size).cast("int").alias("columns"),
        )
    )
    known = visits.join(counts, bucket, "left").na.fill(1, ["rows", "columns"])
    rest = [c for c in visits.columns if c not in (*bucket, "resident")]
    here = lambda n, salt: F.pmod(F.xxhash64(item, F.lit(salt)), n).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    visiting = known.select(
        *bucket, all_of("rows").alias("r"), here("columns", 1).alias("v"), F.lit(False).alias("resident"), *rest
    )
    resident = known.where("resident").select(
        *bucket, here("rows", 2).alias("r"), all_of("columns").alias("v"), F.lit(True).alias("resident"), *rest
    )
    return visiting.unionByName(resident)
