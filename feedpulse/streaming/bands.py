"""Alert bands kept in a stream operator's state: the latest buckets of each metric, and nothing else.

The decision of ``alerts.anomaly_backtest``, made for each bucket as it closes. What it depends on, nine
buckets of a metric, is the operator's state, which Spark checkpoints with the stream; there
is no folder of recent buckets to hand on and no batch function that has to be repeatable.

The state functions run in Python. Their input is a row for each closed bucket and metric, not events.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from feedpulse.operators.alerts import ALL_METRICS, bucket_labels, context_rows
from feedpulse.streaming.activity import LATENESS, start
from feedpulse.streaming.both_services import activity_15min_full_stream

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STEP = 15 * 60
JUDGED = (
    "metric string, start long, value double, previous double, deviation double, low double, high double,"
    " is_alert boolean"
)


def quantile(values: Sequence[float], q: float) -> float:
    """Between the two nearest values, in proportion."""
    ordered = sorted(values)
    at = (len(ordered) - 1) * q
    below, above = ordered[math.floor(at)], ordered[math.ceil(at)]
    return below + (above - below) * (at - math.floor(at))


def raw_band(before: Sequence[float | None], a: float, n: int) -> tuple[float, float] | None:
    """Quartiles of the ``n`` buckets before, widened; None unless all have a value."""
    if len(before) < n or any(v is None for v in before):
        return None
    q25, q75 = quantile(before, 0.25), quantile(before, 0.75)
    return q25 - a * (q75 - q25), q75 + a * (q75 - q25)


def band(values: Sequence[float | None], a: float, n: int) -> tuple[float, float] | None:
    """The band of the last of ``values``: raw bands of it and the ``n // 2`` before, averaged."""
    ends = range(max(len(values) - n // 2 - 1, 0), len(values))
    raw = [b for i in ends if (b := raw_band(values[max(i - n, 0) : i], a, n))]
    if not raw:
        return None
    return sum(b[0] for b in raw) / len(raw), sum(b[1] for b in raw) / len(raw)


class Bands(StatefulProcessor):
    """Judges a metric's buckets in order; ``fill`` takes buckets that are skipped as zero, as ``alerts.fill_gaps``."""

    def __init__(self, a: float, n: int, fill: bool) -> None:
        self.a, self.n, self.fill = a, n, fill

    def init(self, handle) -> None:
        self.recent = handle.getListState("recent", "start long, value double")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        (metric,) = key
        known = [(r[0], r[1]) for r in self.recent.get()] if self.recent.exists() else []
        # A bucket closes once, so there is one row for it.
        for at, value in sorted(((r["start"], r["value"]) for r in rows), key=lambda x: x[0]):
            for between in self.skipped(known, at):
                known, judged = self.judged(known, metric, between, None if metric == "ctr" else 0.0)
                yield judged
            known, judged = self.judged(known, metric, at, value)
            yield judged
        self.recent.put(known)

    def skipped(self, known: list, at: int) -> Iterator[int]:
        return iter(range(known[-1][0] + STEP, at, STEP) if self.fill and known else ())

    def judged(self, known: list, metric: str, at: int, value: float | None) -> tuple[list, Row]:
        known = [*known, (at, value)][-(context_rows(self.n) + 1) :]
        values = [v for _, v in known]
        low, high = band(values, self.a, self.n) or (None, None)
        previous = values[-2] if len(values) > 1 else None
        deviation = None
        if value is not None and previous:
            deviation = round((value - previous) / previous * 100, 2)
        outside = value is not None and low is not None and not low <= value <= high
        return known, Row(
            metric=metric, start=at, value=value, previous=previous, deviation=deviation, low=low, high=high,
            is_alert=outside,
        )


def judged_stream(
    feed: DataFrame,
    msg: DataFrame,
    metrics: Sequence[str] = ALL_METRICS,
    a: float = 4,
    n: int = 6,
    lateness: str = LATENESS,
    fill: bool = False,
) -> DataFrame:
    """Every closed bucket and metric with its band, for append mode."""
    closed = activity_15min_full_stream(feed, msg, lateness)
    at = F.unix_timestamp(F.concat_ws(" ", "date", "minutes"), "yyyy-MM-dd HH:mm").alias("start")
    values = closed.select(at, *[F.col(m).cast("double").alias(m) for m in metrics])
    rows = values.unpivot(["start"], list(metrics), "metric", "value")
    judged = rows.groupBy("metric").transformWithState(
        statefulProcessor=Bands(a, n, fill), outputStructType=JUDGED, outputMode="Append", timeMode="None"
    )
    labels = judged.withColumn("bucket", F.timestamp_seconds("start"))
    columns = ("value", "previous", "deviation", "low", "high", "is_alert")
    return labels.select("metric", *bucket_labels(), *columns)


def alerts_to_table(
    feed: DataFrame,
    msg: DataFrame,
    path: str,
    checkpoint: str,
    flagged_only: bool = True,
    processing_time: str | None = None,
    **settings,
) -> StreamingQuery:
    """Append the alerts (or all judged buckets) to Parquet files, exactly once. Uses the RocksDB state store."""
    spark = feed.sparkSession
    judged = judged_stream(feed, msg, **settings)
    writer = (judged.where("is_alert") if flagged_only else judged).writeStream.outputMode("append")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:  # the query keeps the setting it is started with
        return start(writer.format("parquet").option("path", path), checkpoint, processing_time)
    finally:
        spark.conf.set(PROVIDER, before)
