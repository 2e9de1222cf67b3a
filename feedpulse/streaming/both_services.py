"""15-minute activity of both services as a stream, and its corrections when events come late."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedpulse.functions.measures import total
from feedpulse.operators.alerts import (
    ALL_METRICS,
    BUCKET,
    USER_SUMS,
    anomaly_backtest,
    bucket_labels,
    bucket_start,
    feed_rows,
    full_columns,
    full_metrics,
    message_rows,
)
from feedpulse.sources.readers import with_event_time
from feedpulse.sources.scratch import entries, remove
from feedpulse.streaming.activity import LATENESS, start

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"
MINUTES = 15

PARTIALS = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        *[T.StructField(name, T.LongType()) for name in USER_SUMS],
        T.StructField("day", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
SUMS = ("dau", "likes", "views", "message_users", "messages_sent")
REVISIONS = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        *[T.StructField(name, T.LongType()) for name in SUMS],
        T.StructField("late", T.BooleanType()),
        T.StructField("day", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


# With watermarks


def activity_15min_full_stream(feed: DataFrame, msg: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """All six metrics per closed bucket, for append mode; later events are dropped.

    Each service has its own watermark; which of the two closes a bucket is the policy
    the query is started with (``full_activity_to_table``).
    """
    rows = [
        make(with_event_time(stream).withWatermark("time", lateness))
        for make, stream in ((feed_rows, feed), (message_rows, msg))
    ]
    by_user = rows[0].unionByName(rows[1]).groupBy(F.window("time", BUCKET), "user_id")
    by_bucket = by_user.agg(*[total(name) for name in USER_SUMS]).groupBy(F.window("window", BUCKET).alias("closed"))
    closed = by_bucket.agg(*full_metrics()).withColumn("bucket", F.col("closed")["start"])
    return closed.select(*bucket_labels(), *full_columns())


def full_activity_to_table(
    feed: DataFrame,
    msg: DataFrame,
    path: str,
    checkpoint: str,
    policy: str = "min",
    processing_time: str | None = None,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Append the closed buckets to Parquet files, exactly once.

    ``min``: a bucket closes when both services have passed it, so a silent service holds up
    all, and nothing within ``lateness`` is lost. ``max``: when one has, and the other's
    events behind that are dropped. The policy is fixed with the checkpoint.
    """
    spark = feed.sparkSession
    before = spark.conf.get(POLICY)
    writer = activity_15min_full_stream(feed, msg, lateness).writeStream.outputMode("append")
    spark.conf.set(POLICY, policy)
    try:  # the query keeps the setting it is started with
        return start(writer.format("parquet").option("path", path), checkpoint, processing_time)
    finally:
        spark.conf.set(POLICY, before)


# With corrections


def _floor(at: datetime) -> datetime:
    return at.replace(minute=at.minute // MINUTES * MINUTES, second=0, microsecond=0)


def closed_until(
    newest: dict[str, datetime], before: datetime | None, lateness: timedelta, idle: timedelta
) -> datetime | None:
    """The end of the last closed bucket, given each service's newest event time.

    A service that is ``idle`` behind the other holds nothing up. The end never goes back.
    """
    if not newest:
        return before
    ahead = max(newest.values())
    closed = _floor(min(t for t in newest.values() if t >= ahead - idle) - lateness)
    return closed if before is None else max(closed, before)


def _store(rows: DataFrame, path: str, batch_id: int) -> None:
    """By day and micro-batch; a batch that is run again replaces what it wrote."""
    own = rows.withColumns({"day": F.to_date("bucket"), "batch_id": F.lit(batch_id).cast("long")})
    writer = own.write.partitionBy("day", "batch_id").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def _progress(spark: SparkSession, path: str, batch_id: int) -> tuple[dict[str, datetime], datetime | None]:
    """Each service's newest event time and the end of the last closed bucket, as a batch left them."""
    rows = spark.read.schema("service string, at timestamp").parquet(f"{path}/progress/batch_id={batch_id}").collect()
    known = {r.service: r["at"] for r in rows}
    closed = known.pop("closed", None)
    return known, closed


def corrected_activity(
    feed: DataFrame,
    msg: DataFrame,
    path: str,
    checkpoint: str,
    lateness: timedelta = timedelta(minutes=30),
    idle: timedelta = timedelta(hours=6),
    processing_time: str | None = None,
) -> StreamingQuery:
    """All six metrics per bucket under ``path``, corrected for every event however late.

    Each micro-batch is reduced to users' sums by bucket, which go to ``partials`` by day and
    batch. Buckets that close with the batch, and closed ones its events belong to, are
    added up from the partials of these buckets alone and become a revision in
    ``series``; the batch's sums behind the closing time also go to ``late``. What a batch writes
    depends on its input and the batches before, so one that is run again after a failure
    replaces its own files. ``corrected_series`` reads the newest revisions.

    An event without a time is left out. Users' sums of days that may still be corrected have to stay.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0 and set(entries(spark, f"{path}/progress")) - {"batch_id=0"}:
            raise ValueError(f"{path} holds another run's results; use its checkpoint or another path")
        newest, closed_before = _progress(spark, path, batch_id - 1) if batch_id else ({}, None)
        by_user = batch.groupBy(bucket_start(), "user_id").agg(*[total(name) for name in USER_SUMS])
        _store(by_user, f"{path}/partials", batch_id)
        for service, at in batch.groupBy("service").agg(F.max("time")).collect():  # two rows at most
            newest[service] = max(at, newest.get(service, at))
        closed = closed_until(newest, closed_before, lateness, idle)
        if closed is not None:
            _revise(spark, path, batch_id, closed_before, closed)
        rows = [*newest.items(), *([("closed", closed)] if closed else [])]
        left = spark.createDataFrame(rows, "service string, at timestamp").coalesce(1)
        left.write.mode("overwrite").parquet(f"{path}/progress/batch_id={batch_id}")
        remove(spark, f"{path}/progress/batch_id={batch_id - 2}")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.where(F.col("time").isNotNull()).persist()
        try:
            check(batch, batch_id)
        finally:
            batch.unpersist()

    rows = [
        make(with_event_time(stream)).withColumn("service", F.lit(name))
        for name, make, stream in (("feed", feed_rows, feed), ("message", message_rows, msg))
    ]
    writer = rows[0].unionByName(rows[1]).writeStream.outputMode("append").foreachBatch(on_batch)
    return start(writer, checkpoint, processing_time)


def _revise(spark: SparkSession, path: str, batch_id: int, before: datetime | None, closed: datetime) -> None:
    stored = spark.read.schema(PARTIALS).parquet(f"{path}/partials").where(F.col("batch_id") <= batch_id)
    own = stored.where(F.col("batch_id") == batch_id)
    touched = []
    if before is None:
        touched.append(stored.where(F.col("bucket") < F.lit(closed)).withColumn("late", F.lit(False)))
    else:
        behind = own.where(F.col("bucket") < F.lit(before))
        _store(behind.drop("day", "batch_id"), f"{path}/late", batch_id)
        new = stored.where((F.col("bucket") >= F.lit(before)) & (F.col("bucket") < F.lit(closed)))
        new = new.where(F.col("day").between(F.to_date(F.lit(before)), F.to_date(F.lit(closed))))
        touched.append(new.withColumn("late", F.lit(False)))
        # Days pick the folders to read, buckets the rows.
        days = [r.day for r in behind.select("day").distinct().collect()]
        if days:
            again = stored.where(F.col("day").isin(days)).join(behind.select("bucket").distinct(), "bucket", "left_semi")
            touched.append(again.withColumn("late", F.lit(True)))
    rows = touched[0]
    for more in touched[1:]:
        rows = rows.unionByName(more)
    by_user = rows.groupBy("bucket", "user_id").agg(*[total(n) for n in USER_SUMS], F.max("late").alias("late"))
    by_bucket = by_user.groupBy("bucket").agg(*full_metrics(), F.max("late").alias("late"))
    # A shuffle of the few rows by bucket, a file for each day: the sums are made by all tasks, before it.
    by_day = by_bucket.select("bucket", *SUMS, "late").repartition(F.to_date("bucket"))
    _store(by_day, f"{path}/series", batch_id)


def revisions(spark: SparkSession, path: str) -> DataFrame:
    """Every revision of every bucket, with the micro-batch that made it and whether late events did."""
    return spark.read.schema(REVISIONS).parquet(f"{path}/series")


def corrected_series(spark: SparkSession, path: str) -> DataFrame:
    """The newest revision of every closed bucket, in the form of ``alerts.activity_15min_full``."""
    newest = revisions(spark, path).groupBy("bucket").agg(F.max_by(F.struct(*SUMS), "batch_id").alias("newest"))
    return newest.select("bucket", "newest.*").select(*bucket_labels(), *full_columns())


def corrected_alerts(
    spark: SparkSession, path: str, metrics: Sequence[str] = ALL_METRICS, a: float = 4, n: int = 6
) -> DataFrame:
    """The anomalous buckets of the series as it stands now: late events may make or withdraw an alert.

    Judged on what was known of earlier buckets only, as ``alerts.anomaly_backtest`` does. The series has 96 rows a day.
    """
    return anomaly_backtest(corrected_series(spark, path), metrics, a, n).where("is_alert")
