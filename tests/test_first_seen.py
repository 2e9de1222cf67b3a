from datetime import date
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import on_days
from feedpulse.operators import first_seen, retention
from oracle import sample

CUT = date(2024, 1, 20)


@pytest.fixture
def kept(spark, tmp_path):
    """Add parts as days' jobs would; the names of the two tables."""

    def add(*parts, hot_users=150, buckets=8):
        name = f"t_{uuid4().hex}"
        for part in parts:
            first_seen.add_day(part, f"{name}_events", f"{name}_firsts", str(tmp_path / name), hot_users, buckets)
        return f"{name}_events", f"{name}_firsts"

    return add


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df):
    return sorted(df.select(*sorted(df.columns)).collect(), key=str)


def parts_of(feed):
    return on_days(feed, None, date(2024, 1, 9)), on_days(feed, date(2024, 1, 10), CUT), on_days(feed, date(2024, 1, 21), None)


@pytest.mark.parametrize("hot_users", [3, 150, 10_000])
def test_day_by_day_equals_the_history(spark, sample_feed, kept, hot_users):
    names = kept(*parts_of(sample_feed), hot_users=hot_users)
    assert rows(first_seen.first_action_date(spark, *names)) == rows(retention.first_action_date(sample_feed))
    got = first_seen.cohort_retention(spark, *names, sample.CAMPAIGN, sample.CAMPAIGN)
    assert rows(got) == rows(retention.campaign_daily_retention(sample_feed, sample.CAMPAIGN))


def test_a_late_day_lowers_first_dates(spark, sample_feed, kept):
    early, middle, late = parts_of(sample_feed)
    names = kept(late, middle, early)
    assert rows(first_seen.first_action_date(spark, *names)) == rows(retention.first_action_date(sample_feed))


def test_the_join_moves_no_row(spark, sample_feed, kept, no_broadcast):
    names = kept(*parts_of(sample_feed))
    df = first_seen.first_action_date(spark, *names)
    df.collect()
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_hot_users_are_in_many_buckets(spark, sample_feed, kept, no_broadcast):
    early, middle, late = parts_of(sample_feed)
    names = kept(early, middle, late, hot_users=150)
    df = first_seen.first_action_date(spark, *names)
    tasks = df.withColumn("task", F.spark_partition_id()).groupBy("user_id").agg(
        F.count_distinct("task").alias("tasks"), F.count_if(F.col("action_time") > F.lit(CUT)).alias("events")
    )
    # Hot by what was known before the last part came.
    known = sample_feed.where(F.to_date("time") <= F.lit(CUT))
    n = known.count()
    hot = {r.user_id for r in known.groupBy("user_id").count().where(F.col("count") * 150 > n).collect()}
    spread = [r for r in tasks.collect() if r.user_id in hot and r.events > 20]
    assert spread and all(r.tasks > 3 for r in spread)


def test_one_user_with_most_events_and_events_of_nobody(spark, make_feed, kept):
    day = [(1, "view", f"2024-01-02 10:{i:02d}") for i in range(50)] + [(2, "view", "2024-01-02")]
    more = [(1, "view", f"2024-01-03 10:{i:02d}") for i in range(50)] + [(None, "view", "2024-01-03")]
    cold = [(n, "view", "2024-01-04") for n in range(3, 300)] + [(1, "view", "2024-01-04")]
    late = [(1, "view", "2023-12-31"), (2, "view", "2024-01-05"), (None, "view", "2023-12-31")]
    feeds = [make_feed(*x) for x in (day, more, cold, late)]
    names = kept(*feeds, hot_users=3)
    whole = feeds[0].unionByName(feeds[1]).unionByName(feeds[2]).unionByName(feeds[3])
    assert rows(first_seen.first_action_date(spark, *names)) == rows(retention.first_action_date(whole))
    salts = spark.table(names[0]).where("user_id = 1").select("salt").distinct().count()
    assert salts > 10  # the second day's; on the first nobody was known, on the third the user is not hot any more
    assert spark.table(names[1]).where("user_id = 1").count() == first_seen.SALTS + 1


def test_nothing(spark, make_feed, kept):
    names = kept(make_feed((1, "view", "2024-01-02")).limit(0))
    assert first_seen.first_action_date(spark, *names).count() == 0
    assert first_seen.cohort_retention(spark, *names, CUT, CUT).count() == 0
