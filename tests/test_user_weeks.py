from datetime import date

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import days
from feedpulse.operators import retention, user_weeks
from feedpulse.plans import jobs
from feedpulse.sources import versions
from feedpulse.sources.writers import write_actions
from oracle import sample

AS_OF = sample.AS_OF


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory, sample_feed):
    path = str(tmp_path_factory.mktemp("feed"))
    write_actions(sample_feed, path)
    return spark.read.parquet(path)


def kept(spark, path):
    return user_weeks.read_state(spark, path)


@pytest.mark.parametrize("weeks", [1, 3, 200])
def test_weeks_one_by_one_equal_the_history(spark, by_day, tmp_path, weeks):
    path = str(tmp_path)
    cut = sample.LAST_DAY - days(7 * weeks) if weeks < 200 else sample.FIRST_DAY
    if weeks < 200:
        user_weeks.extend(by_day, path, sample.FIRST_DAY, cut)
        for week in range(weeks):
            day = cut + days(7 * (week + 1))
            user_weeks.extend(by_day, path, day, day)
    else:
        user_weeks.extend(by_day, path, sample.FIRST_DAY, sample.LAST_DAY)
    state = kept(spark, path)
    assert rows(user_weeks.activity_status(state, AS_OF)) == rows(retention.weekly_activity_status(by_day, AS_OF))
    for source in ("ads", "organic"):
        want = retention.weekly_retention(by_day, source)
        assert rows(user_weeks.cohort_sizes(state, source)) == rows(want)


def test_only_the_new_weeks_events_are_read(spark, by_day, tmp_path):
    """The other days' files cannot be read any more."""
    path, feed = str(tmp_path / "state"), tmp_path / "feed"
    user_weeks.extend(by_day, path, sample.FIRST_DAY, sample.LAST_DAY - days(7))
    by_day.write.partitionBy("event_date").parquet(str(feed))
    week = {f"event_date={user_weeks.monday_of(sample.LAST_DAY) + days(n)}" for n in range(7)}
    folders = [f for f in feed.glob("event_date=*") if f.name not in week]
    assert len(folders) > 100
    for file in (x for folder in folders for x in folder.glob("*.parquet")):
        file.write_bytes(b"gone")
        file.with_name(f".{file.name}.crc").unlink()
    new = spark.read.schema(by_day.schema).parquet(str(feed))
    user_weeks.extend(new, path, sample.LAST_DAY, sample.LAST_DAY)
    status = user_weeks.activity_status(kept(spark, path), AS_OF)
    assert rows(status) == rows(retention.weekly_activity_status(by_day, AS_OF))
    with pytest.raises(Exception, match="not a Parquet file"):
        new.count()


def test_a_late_event_and_a_repeated_week(spark, make_feed, tmp_path):
    path = str(tmp_path)
    first = make_feed((1, "view", "2024-01-10"), (2, "view", "2024-01-10"), (None, "view", "2024-01-10"))
    late = make_feed((1, "view", "2023-12-06"), (3, "view", "2024-01-17"))
    user_weeks.extend(first, path, date(2024, 1, 8), date(2024, 1, 21))
    for _ in range(2):
        user_weeks.extend(late, path, date(2023, 12, 4), date(2024, 1, 21))
    everything = first.unionByName(late).where("user_id IS NOT NULL")
    state = kept(spark, path)
    assert rows(user_weeks.cohort_sizes(state, "ads")) == rows(retention.weekly_retention(everything, "ads"))
    assert rows(user_weeks.activity_status(state, AS_OF)) == rows(retention.weekly_activity_status(everything, AS_OF))


def test_weeks_across_blocks(spark, make_feed, tmp_path):
    cut = user_weeks.EPOCH + days(7 * user_weeks.WEEKS * (user_weeks.week_number(AS_OF) // user_weeks.WEEKS))
    text = lambda n: (cut + days(n)).isoformat()
    feed = make_feed(
        (1, "view", text(-7)), (1, "view", text(0)), (2, "view", text(-1)), (3, "view", text(3)), (3, "view", text(-7 * 70))
    )
    path = str(tmp_path)
    user_weeks.extend(feed, path, cut - days(7 * 71), cut + days(20))
    assert len(versions.parts(spark, path)) == 3
    state, as_of = kept(spark, path), cut + days(7)
    assert rows(user_weeks.activity_status(state, as_of)) == rows(retention.weekly_activity_status(feed, as_of))
    assert rows(user_weeks.cohort_sizes(state, "ads")) == rows(retention.weekly_retention(feed, "ads"))
    recent = user_weeks.activity_status(user_weeks.read_state(spark, path, cut - days(7)), as_of, cut)
    want = retention.weekly_activity_status(feed, as_of).where(F.col("week") >= F.lit(cut))
    assert rows(recent) == rows(want)


def test_negative_weeks_and_nobody(spark, make_feed, tmp_path):
    feed = make_feed((1, "view", "1969-12-30"), (1, "view", "1970-01-06"))
    path = str(tmp_path)
    user_weeks.extend(feed, path, date(1969, 12, 29), date(1970, 1, 11))
    as_of = date(1970, 1, 12)
    assert rows(user_weeks.activity_status(kept(spark, path), as_of)) == rows(
        retention.weekly_activity_status(feed, as_of)
    )
    nobody = str(tmp_path / "nobody")
    user_weeks.extend(feed.limit(0), nobody, date(2024, 1, 1), date(2024, 1, 2))
    assert user_weeks.activity_status(kept(spark, nobody), AS_OF).count() == 0
    assert user_weeks.cohort_sizes(kept(spark, nobody), "ads").count() == 0


def test_job(spark, by_day, tmp_path):
    path = str(tmp_path)
    jobs.weekly_report_kept(by_day, AS_OF - days(7), path, first=sample.FIRST_DAY)
    got, want = jobs.weekly_report_kept(by_day, AS_OF, path), jobs.weekly_report(by_day, AS_OF)
    assert set(got) == set(want)
    for name in want:
        assert rows(got[name]) == rows(want[name])
