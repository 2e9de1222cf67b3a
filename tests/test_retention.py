from datetime import date

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import monday
from feedpulse.operators import retention

AS_OF = date(2024, 1, 31)


def status(df):
    return {(r.week.isoformat(), r.status): r.num_users for r in df.collect()}


def test_user_who_skips_a_week_is_new_again(make_feed):
    feed = make_feed((1, "view", "2024-01-03"), (1, "view", "2024-01-04"), (1, "view", "2024-01-17"))
    assert status(retention.weekly_activity_status(feed, AS_OF)) == {
        ("2024-01-01", "new"): 1,
        ("2024-01-08", "gone"): -1,
        ("2024-01-15", "new"): 1,
        ("2024-01-22", "gone"): -1,
    }


def test_nobody_is_gone_in_the_coming_week(make_feed):
    feed = make_feed((1, "view", "2024-01-22"), (1, "view", "2024-01-30"), (2, "view", "2024-01-22"))
    got = status(retention.weekly_activity_status(feed, AS_OF))
    assert got == {
        ("2024-01-22", "new"): 2,
        ("2024-01-29", "retained"): 1,
        ("2024-01-29", "gone"): -1,
    }
    assert retention.weekly_activity_status(feed, AS_OF, limit=1).first().num_users == 2


def test_statuses_add_up_to_active_users(sample_feed):
    got = status(retention.weekly_activity_status(sample_feed, AS_OF))
    weeks = sample_feed.groupBy(monday(F.col("time")).alias("week")).agg(
        F.count_distinct("user_id").alias("users")
    )
    active = {r.week.isoformat(): r.users for r in weeks.collect()}
    for week, users in active.items():
        assert got.get((week, "new"), 0) + got.get((week, "retained"), 0) == users
        after = date.fromordinal(date.fromisoformat(week).toordinal() + 7).isoformat()
        if after != "2024-02-05":
            assert -got.get((after, "gone"), 0) == users - got.get((after, "retained"), 0)


def test_cohorts_are_within_a_source(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-01", {"source": "organic"}),
        (1, "view", "2024-01-10", {"source": "ads"}),
        (1, "view", "2024-01-25", {"source": "ads"}),
        (2, "view", "2024-01-10", {"source": "ads"}),
    )
    got = [tuple(r) for r in retention.weekly_retention(feed, "ads").collect()]
    first = date(2024, 1, 8)
    assert got == [(first, first, 0, 2), (first, date(2024, 1, 22), 2, 1)]
    percent = [r.percent_rt for r in retention.weekly_retention_percent(feed, "ads").collect()]
    assert percent == [100.0, 50.0]
    assert retention.weekly_retention(feed, "ads", limit=1).count() == 1


@pytest.mark.parametrize("source", ["ads", "organic"])
def test_cohort_is_largest_in_its_first_week(sample_feed, source):
    for r in retention.weekly_retention_percent(sample_feed, source, 2).where("week_number = 0").collect():
        assert r.percent_rt == 100.0


@pytest.mark.parametrize("hot_users", [1, 3, 150, 10_000])
def test_first_dates_do_not_depend_on_which_users_are_hot(sample_feed, hot_users):
    got = retention.first_action_date(sample_feed, hot_users, salts=8)
    want = sample_feed.select("user_id", F.to_date("time").alias("day")).groupBy("user_id").agg(
        F.min("day").alias("want")
    )
    assert got.count() == sample_feed.count()
    assert got.join(want, "user_id").where("NOT first_action <=> want").count() == 0


def test_one_user_with_most_events(make_feed):
    feed = make_feed(
        *[(1, "view", f"2024-01-02 10:{i:02d}") for i in range(50)],
        (1, "view", "2024-01-01"),
        (2, "view", "2024-01-05"),
    )
    got = retention.first_action_date(feed, hot_users=3).groupBy("user_id", "first_action").count()
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, date(2024, 1, 1), 51),
        (2, date(2024, 1, 5), 1),
    ]


def test_campaign_cohort_is_over_all_sources(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-01", {"source": "ads"}),
        (1, "view", "2024-01-02", {"source": "organic"}),
        (2, "view", "2024-01-01", {"source": "ads"}),
        (3, "view", "2024-01-02", {"source": "organic"}),
    )
    counts = retention.campaign_daily_retention(feed, date(2024, 1, 1))
    got = {
        (r.source, r.action_time.day): (r.retention, r.retention_share)
        for r in retention.campaign_retention_share(counts).collect()
    }
    assert got == {("ads", 1): (2, 100.0), ("organic", 2): (1, 100.0)}
    around = retention.campaign_vs_neighbours(feed, date(2024, 1, 1), 1)
    assert sorted((r.source, r.first_action.day, r.day_number) for r in around.collect()) == [
        ("ads", 1, 0),
        ("organic", 1, 1),
        ("organic", 2, 0),
    ]
