from datetime import date

import pytest
from pyspark.sql import functions as F

from feedpulse.operators import rollup
from feedpulse.plans import jobs
from feedpulse.sources.schema import DAILY_ROLLUP, ROLLUP_METRICS
from feedpulse.sources import writers
from feedpulse.sources.writers import daily_rollup_save, daily_rollup_write

AS_OF = date(2024, 1, 31)
DAY, EARLIER = "2024-01-30", "2024-01-10"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_age_bands_and_gender_labels(make_feed):
    ages = [24, 25, 35, 36, 50, 51, None]
    feed = make_feed(*[(i, "view", DAY, {"age": a, "gender": i % 2}) for i, a in enumerate(ages)])
    got = rows(rollup.user_demographics(feed), "user_id", "gender", "age_group")
    bands = ["below 25", "25-35", "25-35", "36-50", "36-50", "50+", "50+"]
    assert got == [(i, "male" if i % 2 else "female", b) for i, b in enumerate(bands)]


def test_only_yesterday_counts(make_feed):
    feed = make_feed(
        (1, "like", "2024-01-30 00:00"),
        (1, "view", "2024-01-30 23:59"),
        (1, "view", "2024-01-31 00:00"),
        (1, "view", "2024-01-29 23:59"),
    )
    assert rows(rollup.feed_user_daily(feed, AS_OF), "user_id", "likes", "views") == [(1, 1, 1)]


def test_messages_count_for_both_ends(make_messages):
    msg = make_messages((1, 2, DAY), (1, 2, DAY), (1, 3, DAY), (2, 1, DAY), (4, 4, DAY), (5, 6, EARLIER))
    got = rows(rollup.message_user_daily(msg, AS_OF), "user_id", *rollup.MESSAGE_METRICS)
    assert got == [(1, 3, 2, 1, 1), (2, 1, 1, 2, 1), (3, 0, 0, 1, 1), (4, 1, 1, 1, 1)]


def test_user_without_feed_history_gets_default_dimensions(make_feed, make_messages):
    feed = make_feed((1, "view", EARLIER, {"os": "Android", "age": 60}))
    daily = rollup.message_user_daily(make_messages((1, 2, DAY)), AS_OF)
    columns = ["user_id", "gender", "age_group", "os"]
    assert rows(rollup.message_user_dims(daily, feed), *columns) == [
        (1, "male", "50+", "Android"),
        (2, "female", "below 25", ""),
    ]
    unknown = rollup.message_user_dims(daily, feed, unmatched="unknown")
    assert rows(unknown, *columns)[1] == (2, "unknown", "unknown", "unknown")


def test_changed_attribute_repeats_the_user(make_feed, make_messages):
    feed = make_feed((1, "view", EARLIER, {"os": "iOS"}), (1, "view", DAY, {"os": "Web"}))
    daily = rollup.message_user_daily(make_messages((1, 1, DAY)), AS_OF)
    assert rows(rollup.message_user_dims(daily, feed), "os", "messages_sent") == [("Web", 1), ("iOS", 1)]
    latest = rollup.message_user_dims(daily, feed, dims="latest")
    assert rows(latest, "os", "messages_sent") == [("Web", 1)]
    with pytest.raises(ValueError):
        rollup.user_dims(feed, "newest")


def test_null_os_matches_itself_and_is_a_value_of_its_own(make_feed, make_messages):
    feed = make_feed((1, "like", DAY, {"os": None}))
    dims = rollup.message_user_dims(rollup.message_user_daily(make_messages((1, 1, DAY)), AS_OF), feed)
    merged = rollup.user_daily_merged(rollup.feed_user_daily(feed, AS_OF), dims)
    assert rows(merged, "user_id", "likes", "messages_sent") == [(1, 1, 1)]
    by_os = rollup.dimension_rollup(merged).where("dimension = 'os'")
    assert rows(by_os, "dimension_value", "likes", "messages_sent") == [("0", 1, 1)]
    unknown = rollup.user_daily_merged(rollup.feed_user_daily(feed, AS_OF), dims, unmatched="unknown")
    assert rows(unknown, "os") == [("unknown",)]


def test_final_equals_the_steps_and_every_dimension_has_the_same_total(sample_feed, sample_messages):
    feed = sample_feed
    assert feed.where("os IS NULL AND time >= TIMESTAMP '2024-01-30'").count()
    by_user = rollup.message_user_dims(rollup.message_user_daily(sample_messages, AS_OF), feed)
    merged = rollup.user_daily_merged(rollup.feed_user_daily(feed, AS_OF), by_user)
    final = rollup.daily_rollup_final(feed, sample_messages, AS_OF)
    names = ["dimension", "dimension_value", *ROLLUP_METRICS]
    assert rows(final, *names) == rows(rollup.dimension_rollup(merged), *names)
    totals = final.groupBy("dimension").agg(*[F.sum(m).alias(m) for m in ROLLUP_METRICS])
    assert len(totals.select(*ROLLUP_METRICS).distinct().collect()) == 1
    assert final.columns == DAILY_ROLLUP.fieldNames()
    assert [f.dataType for f in final.schema] == [f.dataType for f in DAILY_ROLLUP]


def test_rerun_leaves_one_copy_and_other_days_stay(spark, tmp_path, make_feed, make_messages):
    feed = make_feed((1, "like", DAY), (1, "like", "2024-01-29"))
    msg = make_messages((1, 2, DAY))
    path = str(tmp_path / "rollup")
    for day in (date(2024, 1, 30), AS_OF, AS_OF):
        daily_rollup_write(rollup.daily_rollup_final(feed, msg, day), path)
    one_day = rollup.daily_rollup_final(feed, msg, AS_OF)
    stored = spark.read.schema(DAILY_ROLLUP).parquet(path)
    assert stored.where("event_date = DATE '2024-01-30'").count() == one_day.count()
    assert stored.where("event_date = DATE '2024-01-29'").count() > 0
    daily_rollup_write(one_day, path, mode="append")
    stored = spark.read.schema(DAILY_ROLLUP).parquet(path)
    assert stored.where("event_date = DATE '2024-01-30'").count() == 2 * one_day.count()
    with pytest.raises(ValueError):
        daily_rollup_write(one_day, path, mode="merge")


def test_catalog_table_is_created_and_replaced_by_day(spark, make_feed, make_messages):
    final = rollup.daily_rollup_final(make_feed((1, "like", DAY)), make_messages((1, 2, DAY)), AS_OF)
    daily_rollup_save(final, "daily_rollup")
    daily_rollup_save(final, "daily_rollup")
    columns = DAILY_ROLLUP.fieldNames()
    assert rows(spark.table("daily_rollup"), *columns) == rows(final, *columns)


def test_a_stop_leaves_the_catalog_tables_day(spark, make_feed, make_messages, monkeypatch):
    columns = DAILY_ROLLUP.fieldNames()
    feed, msg = make_feed((1, "like", DAY)), make_messages((1, 2, DAY))
    old = rollup.daily_rollup_final(feed, msg, AS_OF)
    daily_rollup_save(old, "stopped_rollup")
    more = rollup.daily_rollup_final(feed.unionByName(make_feed((3, "view", DAY))), msg, AS_OF)

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(writers, "_point_to", stop)
        with pytest.raises(KeyboardInterrupt):
            daily_rollup_save(more, "stopped_rollup")
    assert rows(spark.table("stopped_rollup"), *columns) == rows(old, *columns)
    daily_rollup_save(more, "stopped_rollup")
    assert rows(spark.table("stopped_rollup"), *columns) == rows(more, *columns) != rows(old, *columns)
    day = spark.table("stopped_rollup").where("event_date = DATE '2024-01-30'")
    assert day.count() == more.count()


def test_empty_rerun_leaves_nothing(spark, tmp_path, make_feed, make_messages):
    path, names = str(tmp_path / "rollup"), DAILY_ROLLUP.fieldNames()
    feed, msg = make_feed((1, "like", DAY)), make_messages((1, 2, DAY))
    first = jobs.daily_rollup(feed, msg, AS_OF, path=path, table="rerun_rollup")
    assert rows(spark.read.schema(DAILY_ROLLUP).parquet(path), *names) == rows(first, *names) != []
    assert jobs.daily_rollup(feed.limit(0), msg.limit(0), AS_OF, path=path, table="rerun_rollup").count() == 0
    assert spark.read.schema(DAILY_ROLLUP).parquet(path).count() == 0
    assert spark.table("rerun_rollup").count() == 0


def test_first_event_on_the_day_of_the_run_counts_in_no_mode(tmp_path, make_feed, make_messages):
    feed = make_feed((9, "view", EARLIER), (1, "view", "2024-01-31 00:10", {"age": 30}))
    msg, dims_path = make_messages((1, 1, DAY)), str(tmp_path / "dims")
    with pytest.raises(ValueError, match="2024-01-30"):
        jobs.daily_rollup(feed, msg, AS_OF, dims_path=dims_path)
    jobs.backfill_dims(feed, date(2024, 1, 30), dims_path)
    names = DAILY_ROLLUP.fieldNames()
    want = rows(rollup.daily_rollup_final(feed, msg, AS_OF), *names)
    assert rows(jobs.daily_rollup(feed, msg, AS_OF, dims_path=dims_path), *names) == want
    assert {r[2] for r in want} == {"female", "below 25", ""}


def test_kept_dimensions_give_the_same_rollup(tmp_path, sample_feed, sample_messages):
    dims_path = str(tmp_path / "dims")
    jobs.backfill_dims(sample_feed, date(2024, 1, 30), dims_path)
    names = DAILY_ROLLUP.fieldNames()
    want = rows(rollup.daily_rollup_final(sample_feed, sample_messages, AS_OF), *names)
    for _ in range(2):
        kept = jobs.daily_rollup(sample_feed, sample_messages, AS_OF, dims_path=dims_path)
        assert rows(kept, *names) == want
