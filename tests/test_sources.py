import subprocess
import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import SPANS, on_any_day, on_days, spans
from feedpulse.operators import rollup
from feedpulse.sources import readers
from feedpulse.sources.schema import FEED_ACTIONS, MESSAGE_ACTIONS, conform
from feedpulse.sources.scratch import scratch_path
from feedpulse.sources.writers import write_actions

AS_OF = date(2024, 1, 31)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="post_id"):
        conform(spark.range(1).withColumnRenamed("id", "user_id"), FEED_ACTIONS)


def test_misspelled_receiver_is_accepted(make_messages):
    msg = make_messages((1, 2, "2024-01-30")).withColumnRenamed("receiver_id", "reciever_id")
    assert "receiver_id" in conform(msg, MESSAGE_ACTIONS).columns


def test_csv_is_matched_by_header(spark, tmp_path, make_messages):
    msg = make_messages((1, 2, "2024-01-30 10:00"), (2, 3, "2024-01-30 11:00", {"os": None}))
    path = str(tmp_path / "csv")
    msg.select("time", "os", *[c for c in msg.columns if c not in ("time", "os")]).write.csv(path, header=True)
    back = readers.read_actions_csv(spark, "message_actions", path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in MESSAGE_ACTIONS]
    assert sorted(back.collect()) == sorted(msg.collect(), key=lambda r: r.user_id)


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_columnar_files(spark, tmp_path, make_feed, format):
    feed = make_feed((1, "view", "2024-01-30"))
    feed.write.format(format).save(str(tmp_path / "feed"))
    assert readers.read_actions(spark, "feed_actions", str(tmp_path / "feed"), format).collect() == feed.collect()


def test_catalog_table_of_a_database(spark, make_feed):
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    make_feed((1, "view", "2024-01-30")).write.mode("overwrite").saveAsTable("app.feed_actions")
    assert readers.read_actions_table(spark, "feed_actions", "app").count() == 1


def test_layout_by_day_prunes_folders_and_pushes_the_time_range(spark, tmp_path, make_feed):
    feed = make_feed(*[(u, "view", f"2024-01-{d}") for u in range(3) for d in range(20, 31)])
    write_actions(feed, str(tmp_path / "feed"))
    stored = readers.read_actions(spark, "feed_actions", str(tmp_path / "feed"))
    daily = rollup.feed_user_daily(stored, AS_OF)
    assert sorted(daily.collect()) == sorted(rollup.feed_user_daily(feed, AS_OF).collect())
    text = plan(daily)
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(time" in text and "LessThan(time" in text
    assert "country" not in text.split("ReadSchema")[1]
    two = on_any_day(stored, date(2024, 1, 30), date(2024, 1, 23))
    assert two.count() == 6 and len(two.inputFiles()) >= 2
    assert "event_date" in plan(two).split("PartitionFilters: [")[1].split("]")[0]
    assert on_days(stored, None, date(2024, 1, 21)).count() == 6


def test_scratch_space_is_where_the_session_says(tmp_path):
    # A static setting, so it takes a session of its own.
    script = (
        "from feedpulse.session import local_session\n"
        "from feedpulse.sources.scratch import scratch_path\n"
        f"spark = local_session(1, spark__checkpoint__dir='{tmp_path}')\n"
        "print(scratch_path(spark, 'x'))\n"
    )
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True)
    assert out.stdout.strip().splitlines()[-1].startswith(f"{tmp_path}/x-")


def test_a_time_of_text_is_refused(spark, make_feed, tmp_path):
    path = str(tmp_path / "text-time")
    make_feed((1, "view", "2024-01-30")).withColumn("time", F.col("time").cast("string")).write.parquet(path)
    with pytest.raises(ValueError, match="time must be a timestamp"):
        readers.read_actions(spark, "feed_actions", path)


def test_the_condition_on_many_days_stays_short(spark):
    """However many days are wanted, the plan compares the time with few bounds."""
    wanted = [date(2023, 1, 1) + timedelta(days=3 * n + n // 7) for n in range(200)]
    first = "CAST(TIMESTAMP '2023-01-01 23:59:59.999' + make_dt_interval(CAST(id DIV 2 AS INT), 0, 0, id % 2 * 0.001) AS {})"
    for kind in ("TIMESTAMP", "TIMESTAMP_NTZ"):
        rows = spark.range(1400).selectExpr("id", f"IF(id < 1390, {first.format(kind)}, NULL) AS time").cache()
        got = on_any_day(rows, *wanted)
        want = rows.where(F.to_date("time").cast("string").isin([d.isoformat() for d in wanted]))
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and want.count() > 300
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(">=") <= SPANS and plan.count("<") <= 2 * SPANS
    assert on_any_day(rows).count() == 0


def test_spans():
    on = lambda *numbers: [date(2024, 1, n) for n in numbers]
    pairs = lambda *numbers: list(zip(*[iter(on(*numbers))] * 2))
    assert spans([]) == [] and spans(on(5, 5)) == pairs(5, 5)
    assert spans(on(4, 1, 2, 9, 3)) == pairs(1, 4, 9, 9)
    assert spans(on(1, 3, 6, 10, 11), 2) == pairs(1, 6, 10, 11)
    assert spans(on(1, 3, 6, 10), 1) == pairs(1, 10)
