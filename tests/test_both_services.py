from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedpulse.operators import alerts
from feedpulse.sources.readers import stream_actions
from feedpulse.streaming import both_services
from feedpulse.streaming.both_services import closed_until, corrected_series, revisions

SINCE = "time >= TIMESTAMP '2024-01-28'"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def until(series, end):
    at = F.to_timestamp(F.concat_ws(" ", "date", "minutes")) + F.expr("INTERVAL 15 MINUTES")
    return series.where(at <= F.lit(end))


def newest(df):
    return df.agg(F.max("time")).first()[0]


@pytest.fixture(scope="module")
def recent(sample_feed, sample_messages):
    return sample_feed.where(SINCE), sample_messages.where(SINCE)


class Arrivals:
    """Two folders that files are put into."""

    def __init__(self, spark, folder, feed, msg):
        self.spark, self.folder = spark, folder
        for name, df in (("feed_actions", feed), ("message_actions", msg)):
            df.limit(0).write.parquet(f"{folder}/{name}")

    def add(self, name, rows):
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def streams(self):
        return [stream_actions(self.spark, n, f"{self.folder}/{n}") for n in ("feed_actions", "message_actions")]


@pytest.fixture
def arrivals(spark, tmp_path, recent):
    return Arrivals(spark, str(tmp_path / "in"), *recent)


def test_six_metrics_equal_the_batch_over_runs(spark, arrivals, recent, tmp_path):
    feed, msg = recent
    for day in (28, 29, 30):
        on_day = F.dayofmonth("time") == day
        arrivals.add("feed_actions", feed.where(on_day))
        arrivals.add("message_actions", msg.where(on_day))
        query = both_services.full_activity_to_table(*arrivals.streams(), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    end = min(newest(feed), newest(msg)) - timedelta(minutes=30)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got) == rows(until(alerts.full_series(feed, msg), end)) and got.count() > 100
    assert spark.conf.get(both_services.POLICY) == "min"


@pytest.mark.parametrize("policy", ["min", "max"])
def test_one_service_is_silent(spark, arrivals, recent, tmp_path, policy):
    feed, msg = recent
    arrivals.add("feed_actions", feed)
    for _ in range(2):
        both_services.full_activity_to_table(
            *arrivals.streams(), str(tmp_path / "out"), str(tmp_path / "cp"), policy
        ).awaitTermination()
    got = spark.read.schema("date date, minutes string, dau long").parquet(str(tmp_path / "out"))
    if policy == "min":
        assert got.count() == 0
    else:
        want = until(alerts.full_series(feed, msg.limit(0)), newest(feed) - timedelta(minutes=30))
        assert rows(got) == rows(want.select("date", "minutes", "dau"))


def correct(arrivals, tmp_path, **settings):
    path = str(tmp_path / "out")
    both_services.corrected_activity(*arrivals.streams(), path, str(tmp_path / "cp"), **settings).awaitTermination()
    return path


def test_shuffled_arrival(spark, arrivals, recent, tmp_path):
    feed, msg = recent
    parts = 5
    for part in range(parts):
        mine = F.pmod(F.xxhash64("user_id", "time"), F.lit(parts)) == part
        arrivals.add("feed_actions", feed.where(mine))
        if part != 2:
            arrivals.add("message_actions", msg.where(mine))
        path = correct(arrivals, tmp_path)
    arrivals.add("message_actions", msg.where(F.pmod(F.xxhash64("user_id", "time"), F.lit(parts)) == 2))
    path = correct(arrivals, tmp_path)
    end = min(newest(feed), newest(msg)) - timedelta(minutes=30)
    want = rows(until(alerts.full_series(feed, msg), end))
    assert rows(corrected_series(spark, path)) == want
    made = revisions(spark, path)
    assert made.where("late").count() > 100 and made.where("NOT late").count() > 10
    # The side table has what came behind the closing time, by batch.
    late = spark.read.parquet(f"{path}/late")
    assert late.agg(F.sum("messages_sent")).first()[0] > 0
    again = late.select("bucket", "batch_id").distinct().count()
    assert again == made.where("late").count()


def test_late_events_change_alerts(spark, make_feed, make_messages, tmp_path):
    """A bucket with few events is anomalous until the rest of them has come."""
    at = lambda m: f"2024-01-29 {10 + m // 60}:{m % 60:02d}"
    usual = [(u, "view", at(15 * b)) for b in range(20) for u in range(10 + b % 3)]
    missing = [x for x in usual if x[2] == at(15 * 12) and x[0] > 1]
    feed = make_feed(*[x for x in usual if x not in missing])
    msg = make_messages(*[(1, 2, at(15 * b)) for b in range(20)])
    arrivals = Arrivals(spark, str(tmp_path / "in"), feed, msg)
    arrivals.add("feed_actions", feed)
    arrivals.add("message_actions", msg)
    path = correct(arrivals, tmp_path)
    alerts_now = lambda: {(r.metric, r.minutes) for r in both_services.corrected_alerts(spark, path).collect()}
    assert ("dau", "13:00") in alerts_now() and ("views", "13:00") in alerts_now()
    arrivals.add("feed_actions", make_feed(*missing))
    correct(arrivals, tmp_path)
    assert not {x for x in alerts_now() if x[1] == "13:00"}


def test_a_batch_that_runs_again_changes_nothing(spark, arrivals, recent, tmp_path):
    """The second batch fails after it has written everything, and is repeated."""
    feed, msg = recent
    first = F.dayofmonth("time") < 30
    arrivals.add("feed_actions", feed.where(first))
    arrivals.add("message_actions", msg.where(first))
    path = correct(arrivals, tmp_path)
    before = rows(corrected_series(spark, path))
    arrivals.add("feed_actions", feed.where(~first))
    arrivals.add("message_actions", msg.where(~first))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(both_services, "remove", lambda *args: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            correct(arrivals, tmp_path)
    path = correct(arrivals, tmp_path)
    end = min(newest(feed), newest(msg)) - timedelta(minutes=30)
    after = rows(corrected_series(spark, path))
    assert after == rows(until(alerts.full_series(feed, msg), end)) and len(after) > len(before)
    assert revisions(spark, path).groupBy("bucket", "batch_id").count().where("count > 1").count() == 0


def test_another_runs_results_are_refused(spark, arrivals, recent, tmp_path):
    feed, _ = recent
    for part in (feed.where("user_id % 2 = 0"), feed.where("user_id % 2 = 1")):
        arrivals.add("feed_actions", part)
        path = correct(arrivals, tmp_path)
    with pytest.raises(Exception, match="another run's results"):
        both_services.corrected_activity(*arrivals.streams(), path, str(tmp_path / "other")).awaitTermination()


def test_one_task_does_not_add_up_all_buckets(spark, make_feed, make_messages, tmp_path, monkeypatch):
    """Reducing the number of tasks without a shuffle would run the sums of all buckets in them."""
    stored, store = {}, both_services._store
    monkeypatch.setattr(
        both_services, "_store", lambda rows, path, batch_id: (stored.update({(path, batch_id): rows}), store(rows, path, batch_id))
    )
    days = [f"2024-01-{d} {h}:20" for d in (10, 11, 29) for h in range(10, 20)]
    feed = make_feed(*[(u, "like", at) for at in days for u in range(3)])
    msg = make_messages(*[(1, 2, at) for at in days])
    arrivals = Arrivals(spark, str(tmp_path / "in"), feed, msg)
    for odd in (0, 1):
        arrivals.add("feed_actions", feed.where(F.hour("time") % 2 == odd))
        arrivals.add("message_actions", msg.where(F.hour("time") % 2 == odd))
        path = correct(arrivals, tmp_path)
    assert rows(corrected_series(spark, path)) == rows(until(alerts.full_series(feed, msg), datetime(2024, 1, 29, 18, 45)))
    series = {n: df for (where, n), df in stored.items() if where == f"{path}/series"}
    assert len(series) >= 2
    for df in series.values():
        assert "Coalesce" not in df._jdf.queryExecution().sparkPlan().toString()
    folders = [f for f in (tmp_path / "out" / "series").glob("day=*/batch_id=*")]
    assert len(folders) >= 4 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_closing_time():
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    half, idle = timedelta(minutes=30), timedelta(hours=6)
    assert closed_until({}, None, half, idle) is None
    assert closed_until({"feed": at(10, 50)}, None, half, idle) == at(10, 15)
    assert closed_until({"feed": at(10, 50), "message": at(9)}, None, half, idle) == at(8, 30)
    assert closed_until({"feed": at(16), "message": at(9)}, at(8, 30), half, idle) == at(15, 30)
    assert closed_until({"feed": at(16), "message": at(14)}, at(15, 30), half, idle) == at(15, 30)
