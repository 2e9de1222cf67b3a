from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedpulse.operators import alerts
from feedpulse.sources.readers import stream_actions
from feedpulse.sources.scratch import clear, entries, stored
from feedpulse.streaming import activity


@pytest.fixture
def arriving(spark, tmp_path, sample_feed):
    """Six hours of files per step, in order of time, so that nothing is late."""
    recent = sample_feed.where("time >= TIMESTAMP '2024-01-27'")
    steps = [
        recent.where(F.floor(F.unix_timestamp("time") / 21600) == s)
        for s in range(*_six_hour_steps(datetime(2024, 1, 27), datetime(2024, 1, 31)))
    ]
    return recent, steps, str(tmp_path / "incoming")


def _six_hour_steps(first, last):
    epoch = datetime(1970, 1, 1)
    return [int((d - epoch).total_seconds() // 21600) for d in (first, last)]


def emitted(spark, feed):
    """The batch series, cut where the stream's watermark is."""
    last = feed.agg(F.max("time")).first()[0]
    closed = F.to_timestamp(F.concat_ws(" ", "date", "minutes")) + F.expr("INTERVAL 45 MINUTES")
    return alerts.activity_series(feed).where(closed <= F.lit(last))


def as_rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_stream_equals_batch_over_several_runs(spark, arriving, tmp_path):
    feed, steps, incoming = arriving
    out, checkpoint = str(tmp_path / "series"), str(tmp_path / "checkpoint")
    for step in steps[:3]:
        step.write.mode("append").parquet(incoming)
        stream = stream_actions(spark, "feed_actions", incoming)
        activity.activity_15min_to_table(stream, out, checkpoint).awaitTermination()
    arrived = spark.read.parquet(incoming)
    columns = ["date", "minutes", *alerts.FEED_METRICS]
    assert as_rows(spark.read.parquet(out), *columns) == as_rows(emitted(spark, arrived), *columns)


def test_alerts_of_each_batch_equal_the_backtest(spark, arriving, tmp_path):
    feed, steps, incoming = arriving
    path, checkpoint = str(tmp_path / "alerts"), str(tmp_path / "checkpoint")
    for step in steps[:4]:
        step.write.mode("append").parquet(incoming)
        stream = stream_actions(spark, "feed_actions", incoming)
        activity.anomaly_alerts_stream(stream, path, checkpoint, a=0.5).awaitTermination()
    series = emitted(spark, spark.read.parquet(incoming))
    want = alerts.anomaly_backtest(series, a=0.5).where("is_alert")
    columns = ["metric", "date", "minutes", "value", "previous", "low", "high"]
    stored = spark.read.parquet(f"{path}/alerts")
    assert stored.select("batch_id").distinct().count() > 1
    assert as_rows(stored, *columns) == as_rows(want, *columns)
    assert as_rows(want, *columns)
    # Running again without new files changes nothing.
    stream = stream_actions(spark, "feed_actions", incoming)
    activity.anomaly_alerts_stream(stream, path, checkpoint, a=0.5).awaitTermination()
    assert as_rows(spark.read.parquet(f"{path}/alerts"), *columns) == as_rows(want, *columns)


def test_late_events_are_dropped_after_the_watermark(spark, make_feed, tmp_path):
    incoming, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for rows in (
        [(1, "view", "2024-01-30 10:00"), (1, "view", "2024-01-30 12:00")],
        [(2, "view", "2024-01-30 10:05"), (2, "view", "2024-01-30 14:00")],
    ):
        make_feed(*rows).write.mode("append").parquet(incoming)
        stream = stream_actions(spark, "feed_actions", incoming)
        activity.activity_15min_to_table(stream, out, checkpoint).awaitTermination()
    got = as_rows(spark.read.parquet(out), "minutes", "dau")
    assert got == [("10:00", 1), ("12:00", 1)]


def test_a_used_path_is_refused_and_old_copies_go(spark, arriving, tmp_path):
    _, steps, incoming = arriving
    path, checkpoint = str(tmp_path / "alerts"), str(tmp_path / "checkpoint")
    for step in steps[:4]:
        step.write.mode("append").parquet(incoming)
        stream = stream_actions(spark, "feed_actions", incoming)
        activity.anomaly_alerts_stream(stream, path, checkpoint, a=0.5).awaitTermination()
    assert len(entries(spark, f"{path}/recent")) == 2
    assert all(x.startswith(("month=", "_")) for x in entries(spark, f"{path}/series"))
    stream = stream_actions(spark, "feed_actions", incoming)
    with pytest.raises(StreamingQueryException, match="another run"):
        activity.anomaly_alerts_stream(stream, path, str(tmp_path / "fresh")).awaitTermination()


def test_stream_reader_knows_the_misspelled_receiver(spark, make_messages, tmp_path):
    incoming, out = str(tmp_path / "in"), str(tmp_path / "out")
    make_messages((1, 2, "2024-01-30")).withColumnRenamed("receiver_id", "reciever_id").write.parquet(incoming)
    stream = stream_actions(spark, "message_actions", incoming)
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.format("parquet").option("path", out).start().awaitTermination()
    assert as_rows(spark.read.parquet(out), "receiver_id") == [(2,)]
    make_messages((1, 2, "2024-01-30")).drop("receiver_id").write.parquet(str(tmp_path / "lacking"))
    with pytest.raises(ValueError, match="receiver_id"):
        stream_actions(spark, "message_actions", str(tmp_path / "lacking"))


def test_scratch_is_empty_after_clearing(spark, make_feed):
    frame = stored(make_feed((1, "view", "2024-01-30")), "some")
    path = frame.inputFiles()[0].rsplit("/", 1)[0]
    assert entries(spark, path)
    clear(spark)
    assert entries(spark, path) == []
