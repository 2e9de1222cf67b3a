from datetime import date

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import days
from feedpulse.operators import dashboards, day_totals, reports
from feedpulse.plans import jobs
from feedpulse.sources import versions
from feedpulse.sources.writers import daily_rollup_read, write_actions
from oracle import sample

AS_OF = sample.AS_OF


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def check(spark, path, feed, msg):
    totals = day_totals.read_totals(spark, path)
    assert rows(totals) == rows(day_totals.day_totals(feed, msg))
    want = reports.activity_change_daily(feed, msg, AS_OF)
    assert rows(day_totals.activity_change(totals, AS_OF)) == rows(want)
    assert rows(day_totals.service_overlap(totals)) == rows(dashboards.service_overlap_daily(feed, msg))


def test_late_events_rebuild_their_days_only(spark, sample_feed, sample_messages, tmp_path):
    path = str(tmp_path)
    late = (F.to_date("time").isin([date(2023, 9, 1), date(2024, 1, 3), date(2024, 1, 30)])) & (F.col("user_id") % 3 == 0)
    feed, msg = sample_feed.where(~late), sample_messages.where(~late)
    day_totals.mark_dirty(path, feed, msg)
    assert len(day_totals.refresh(feed, msg, path)) == day_totals.day_totals(feed, msg).count()
    check(spark, path, feed, msg)
    before = versions.parts(spark, path)
    day_totals.mark_dirty(path, sample_feed.where(late), sample_messages.where(late))
    dirty = day_totals.refresh(sample_feed, sample_messages, path)
    assert set(dirty) <= {date(2023, 9, 1), date(2024, 1, 3), date(2024, 1, 30)} and len(dirty) >= 2
    check(spark, path, sample_feed, sample_messages)
    after = versions.parts(spark, path)
    assert {m for m in after if after[m] != before.get(m)} == {f"{d:%Y-%m}" for d in dirty}
    assert day_totals.refresh(sample_feed, sample_messages, path) == []


def test_only_the_dirty_days_are_read(spark, sample_feed, sample_messages, tmp_path):
    """The other days' files cannot be read any more."""
    path, day = str(tmp_path / "totals"), date(2024, 1, 30)
    tables = {}
    for name, df in (("feed", sample_feed), ("msg", sample_messages)):
        folder = tmp_path / name
        write_actions(df, str(folder))
        tables[name] = spark.read.schema(spark.read.parquet(str(folder)).schema).parquet(str(folder))
    day_totals.mark_dirty(path, *tables.values())
    day_totals.refresh(*tables.values(), path)
    whole = rows(day_totals.read_totals(spark, path))
    for name in tables:
        for file in (tmp_path / name).glob("event_date=*/*.parquet"):
            if file.parent.name != f"event_date={day}":
                file.write_bytes(b"gone")
                file.with_name(f".{file.name}.crc").unlink()
    day_totals.mark_dirty(path, sample_feed.where(F.to_date("time") == F.lit(day)))
    fresh = [spark.read.schema(t.schema).parquet(str(tmp_path / n)) for n, t in tables.items()]
    assert day_totals.refresh(*fresh, path) == [day]
    assert rows(day_totals.read_totals(spark, path)) == whole


@pytest.mark.parametrize("step", ["_replace", "remove"])
def test_a_refresh_that_stops_is_made_up_for(spark, sample_feed, sample_messages, tmp_path, monkeypatch, step):
    path = str(tmp_path)
    day_totals.mark_dirty(path, sample_feed, sample_messages)

    def stop(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(day_totals, step, stop)
    with pytest.raises(KeyboardInterrupt):
        day_totals.refresh(sample_feed, sample_messages, path)
    monkeypatch.undo()
    day_totals.refresh(sample_feed, sample_messages, path)
    check(spark, path, sample_feed, sample_messages)


def test_a_day_that_has_become_empty(spark, make_feed, make_messages, tmp_path):
    path = str(tmp_path)
    feed = make_feed((1, "like", "2024-01-02"), (None, "view", "2024-01-02"), (2, "view", "2024-01-03"))
    msg = make_messages((1, 2, "2024-01-02"), (3, 1, "2024-01-05"))
    day_totals.mark_dirty(path, feed, msg)
    day_totals.refresh(feed, msg, path)
    got = {r.date.day: tuple(r)[1:] for r in day_totals.read_totals(spark, path).collect()}
    assert got == {2: (2, 1, 1, 1, 0, 0, 1), 3: (1, 0, 1, 0, 1, 0, 0), 5: (0, 0, 0, 1, 0, 1, 0)}
    assert day_totals.read_totals(spark, path, date(2024, 1, 3), date(2024, 1, 4)).count() == 1
    fewer = feed.where("user_id = 1")
    day_totals.mark_dirty(path, feed.where("user_id = 2"))
    assert day_totals.refresh(fewer, msg, path) == [date(2024, 1, 3)]
    assert {r.date.day for r in day_totals.read_totals(spark, path).collect()} == {2, 5}


def test_jobs(spark, sample_feed, sample_messages, tmp_path):
    path, rollup = str(tmp_path / "totals"), str(tmp_path / "rollup")
    day_totals.mark_dirty(path, sample_feed, sample_messages)
    tables = jobs.dashboard_days(sample_feed, sample_messages, AS_OF, path)
    assert rows(tables["overlap"]) == rows(dashboards.service_overlap_daily(sample_feed, sample_messages))
    for as_of in (AS_OF, AS_OF - days(1), AS_OF):
        stored = jobs.daily_rollup(sample_feed, sample_messages, as_of, versioned_path=rollup)
    day = AS_OF - days(1)
    assert rows(daily_rollup_read(spark, rollup, day, day)) == rows(stored)
    assert daily_rollup_read(spark, rollup).select("event_date").distinct().count() == 2
    assert daily_rollup_read(spark, rollup, AS_OF).count() == 0
    # The day has become empty.
    jobs.daily_rollup(sample_feed.limit(0), sample_messages.limit(0), AS_OF, versioned_path=rollup)
    assert daily_rollup_read(spark, rollup, day, day).count() == 0
