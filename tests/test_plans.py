"""Properties of the physical plans that matter on large data."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from feedpulse.operators import alerts, experiments, reports, retention, rollup
from feedpulse.plans import jobs
from tests.conftest import SMALL

AS_OF = date(2024, 1, 31)
RUN_STREAMS = {
    "activity_15min_stream",
    "activity_15min_full_stream",
    "activity_15min_corrected",
    "anomaly_alerts_corrected",
    "anomaly_alerts_state",
    "anomaly_alerts_stream",
    "daily_rollup_write",
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, sample_feed, sample_messages):
    root = tmp_path_factory.mktemp("tables")
    sample_feed.write.parquet(f"{root}/feed")
    sample_messages.write.parquet(f"{root}/messages")
    return spark.read.parquet(f"{root}/feed"), spark.read.parquet(f"{root}/messages")


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - RUN_STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    text = registered.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert operator not in text


def scans(text):
    return text.count("FileScan")


def test_single_scans(stored):
    feed, _ = stored
    aa = experiments.user_ctr(feed, date(2024, 1, 15), date(2024, 1, 21), [2, 3])
    assert scans(final_plan(reports.traffic_shares(feed, AS_OF))) == 1
    assert scans(final_plan(retention.weekly_activity_status(feed, AS_OF))) == 1
    merged = rollup.feed_user_daily(feed, AS_OF).selectExpr(
        "*", *[f"0L AS {m}" for m in rollup.MESSAGE_METRICS]
    )
    assert scans(final_plan(rollup.dimension_rollup(merged))) == 1
    linearized = experiments.linearized_ttest(aa, 2, 3)
    linearized.collect()
    assert "ReusedExchange" in linearized._jdf.queryExecution().executedPlan().toString()
    resampled = final_plan(experiments.aa_resample(aa, 2, 3, n=8, iters=20))
    assert scans(resampled) == 1 and resampled.count("ReusedExchange") == 2


def test_draws_are_not_broadcast(stored):
    feed, _ = stored
    aa = experiments.user_ctr(feed, date(2024, 1, 15), date(2024, 1, 21), [2, 3])
    text = final_plan(experiments.aa_resample(aa, 2, 3, n=8, iters=20))
    # The hash table is built of the draws, on the right.
    assert "ShuffledHashJoin" in text and "BuildRight" in text.split("ShuffledHashJoin", 1)[1].split("\n")[0]


def test_histogram_reuses_its_inputs_shuffle(stored):
    feed, _ = stored
    ab = experiments.user_ctr(feed, date(2024, 1, 22), date(2024, 1, 28), [1, 2])
    text = final_plan(experiments.metric_histogram(ab, "ctr", 20, "exp_group"))
    assert "ReusedExchange" in text or text.count("FileScan") == 1


def test_bootstrap_expands_on_all_tasks(stored):
    feed, _ = stored
    uc = experiments.user_ctr(feed, date(2024, 1, 22), date(2024, 1, 28), [1, 2])
    assert "REPARTITION_BY_NUM" in final_plan(experiments.poisson_bootstrap(uc, 1, 2, reps=5))


def test_hot_users_are_spread_in_the_join(spark, stored):
    feed, _ = stored
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = retention.first_action_date(feed, hot_users=100)
        text = final_plan(df)
        tasks = df.groupBy("user_id", F.spark_partition_id().alias("task")).count()
        by_user = tasks.groupBy("user_id").agg(F.sum("count").alias("events"), F.count("*").alias("tasks"))
        users = by_user.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(re.findall(r"hashpartitioning\(slot#\w+", text)) == 2
    assert text.count("ReusedExchange") == 1
    hot = feed.count() / 100
    assert any(u.events > hot for u in users) and any(u.events <= hot for u in users)
    wrong = [u for u in users if (u.tasks > 4) != (u.events > hot)]
    assert not wrong


def test_bands_shuffle_once_after_the_series(stored):
    feed, _ = stored
    series = alerts.activity_series(feed)
    extra = final_plan(alerts.anomaly_backtest(series)).count("Exchange hash") - final_plan(series).count(
        "Exchange hash"
    )
    assert extra == 1


def test_jobs_run(spark, stored, tmp_path):
    feed, msg = stored
    path = str(tmp_path / "rollup")
    assert jobs.daily_rollup(feed, msg, AS_OF, path=path).count() == spark.read.parquet(path).count()
    assert jobs.check_alerts(feed, registered.AS_OF_TS)["alerts"].count() == 0
    assert jobs.feed_report(feed, AS_OF)["row"].count() == 1
    assert jobs.service_report(feed, msg, AS_OF)["rows"].count() == 8
    assert jobs.campaign_report(feed, registered.CAMPAIGN)["retention"].count() > 0
    ab = jobs.ab_report(feed, *registered.AB_WEEK, 1, 2, reps=20)
    assert ab["bootstrap"].first().replicates == 20
    assert ab["linearized"].count() == 1
    aa = jobs.aa_report(feed, *registered.AA_WEEK, 2, 3, n=10, iters=20)
    assert aa["pass_rate"].first().iterations == 20
