"""15-minute activity and anomaly alerts on a stream of feed actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from feedpulse.functions.measures import likes, total, views
from feedpulse.operators.alerts import (
    BUCKET,
    FEED_METRICS,
    anomaly_backtest,
    bucket_labels,
    context_rows,
)
from feedpulse.sources.readers import with_event_time
from feedpulse.sources.scratch import entries, remove

LATENESS = "30 minutes"

SERIES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("minutes", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in FEED_METRICS],
    ]
)


def activity_15min_stream(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Active users (exact), likes and views per closed bucket, for append mode.

    Streams cannot count distinct users in one step, so events are aggregated by
    (bucket, user) and the result by bucket. A bucket is emitted once the watermark
    has passed its end; later events for it are dropped.
    """
    events = with_event_time(stream).withWatermark("time", lateness)
    by_user = events.groupBy(F.window("time", BUCKET), "user_id").agg(likes(), views())
    by_bucket = by_user.groupBy(F.window("window", BUCKET).alias("closed")).agg(
        F.count("user_id").alias("dau"), total("likes"), total("views")
    )
    return by_bucket.withColumn("bucket", F.col("closed")["start"]).select(
        *bucket_labels(), *FEED_METRICS
    )


def start(
    writer: DataStreamWriter, checkpoint: str, processing_time: str | None = None
) -> StreamingQuery:
    """Start a query: with a processing time it keeps running, without it works off the backlog."""
    writer = writer.option("checkpointLocation", checkpoint)
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()


def activity_15min_to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    processing_time: str | None = None,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Append the closed buckets to Parquet files, exactly once."""
    writer = activity_15min_stream(stream, lateness).writeStream.outputMode("append")
    return start(writer.format("parquet").option("path", path), checkpoint, processing_time)


def anomaly_alerts_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    metrics: Sequence[str] = FEED_METRICS,
    a: float = 4,
    n: int = 6,
    processing_time: str | None = None,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Check every bucket when it closes and store the anomalous ones under ``path``/alerts.

    The buckets go to ``series`` and the alerts among them to ``alerts``, by month and
    micro-batch; a batch that is run again after a failure reads the same input and
    replaces what it wrote. The latest buckets, which a later decision may need, are
    handed on in ``recent``: batch k reads what k-1 left, and only the last two
    copies are kept. So no batch has to look through history. A path that holds
    another run's batches is refused.

    Events later than ``lateness`` are left out for good; ``jobs.check_alerts`` on the
    stored events, which reads two whole days, is what to compare with.
    """

    def recent(batch_id: int) -> str:
        return f"{path}/recent/batch_id={batch_id}"

    def store(rows: DataFrame, table: str, batch_id: int) -> None:
        # A few rows for each bucket: one file a month.
        month = F.date_format("date", "yyyy-MM")
        marked = rows.withColumns({"month": month, "batch_id": F.lit(batch_id)}).coalesce(1)
        own = marked.write.partitionBy("month", "batch_id")
        own.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/{table}")

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark, known = batch.sparkSession, batch
        if batch_id > 0:
            known = batch.unionByName(spark.read.schema(SERIES).parquet(recent(batch_id - 1)))
        elif set(entries(spark, f"{path}/recent")) - {"batch_id=0"}:
            raise ValueError(f"{path} holds another run's results; use its checkpoint or another path")
        at = F.struct("date", "minutes")
        first = batch.agg(F.min(at).alias("at")).first()["at"]
        if first is not None:
            judged = anomaly_backtest(known, metrics, a, n)
            own = judged.where(at >= F.struct(F.lit(first["date"]), F.lit(first["minutes"])))
            store(batch, "series", batch_id)
            store(own.where("is_alert"), "alerts", batch_id)
        latest = known.orderBy(F.desc("date"), F.desc("minutes")).limit(context_rows(n))
        latest.write.mode("overwrite").parquet(recent(batch_id))
        remove(spark, recent(batch_id - 2))

    def check(batch: DataFrame, batch_id: int) -> None:
        # At most 96 rows for each day the batch covers; used several times.
        batch = batch.persist()
        try:
            judge(batch, batch_id)
        finally:
            batch.unpersist()

    writer = activity_15min_stream(stream, lateness).writeStream.outputMode("append")
    return start(writer.foreachBatch(check), checkpoint, processing_time)
