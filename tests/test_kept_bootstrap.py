import numpy as np
import pytest
from pyspark.sql import functions as F

from feedpulse.functions.dates import days
from feedpulse.operators import experiments, kept_bootstrap
from feedpulse.operators.kept_bootstrap import bootstrap, day_sums, keep_days
from oracle import sample

FIRST, LAST = sample.AB_WEEK


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_by_day_equals_one_run(spark, sample_feed, tmp_path):
    path = str(tmp_path)
    for n in (3, 0, 1, 2, 5, 6, 4, 3):  # in any order, and a day twice
        keep_days(sample_feed, path, FIRST + days(n), FIRST + days(n), (1, 2), reps=50)
    once = str(tmp_path / "once")
    keep_days(sample_feed, once, FIRST, LAST, (1, 2), reps=50)
    assert rows(bootstrap(spark, path, FIRST, LAST)) == rows(bootstrap(spark, once, FIRST, LAST))
    sums = day_sums(sample_feed, FIRST, LAST, (1, 2), reps=50)
    whole = sums.groupBy("replicate", "exp_group").agg(F.sum("likes").alias("l"), F.sum("views").alias("v"))
    want = rows(whole.select("replicate", "exp_group", F.try_divide("l", "v")))
    assert rows(bootstrap(spark, path, FIRST, LAST)) == want and len(want) == 100
    part = rows(bootstrap(spark, path, FIRST, FIRST + days(2)))
    keep_days(sample_feed, str(tmp_path / "part"), FIRST, FIRST + days(2), (1, 2), reps=50)
    assert part == rows(bootstrap(spark, str(tmp_path / "part"), FIRST, FIRST + days(2)))
    with pytest.raises(ValueError, match="lacks the days"):
        bootstrap(spark, path, FIRST, LAST + days(1))


def test_weights_are_poisson(spark):
    drawn = spark.range(20_000).select(kept_bootstrap.weight(F.col("id"), F.lit(3)).alias("w")).collect()
    weights = np.array([r.w for r in drawn])
    assert abs(weights.mean() - 1) < 0.03 and abs(weights.var() - 1) < 0.06
    assert abs((weights == 0).mean() - np.exp(-1)) < 0.015


def test_the_spread_is_that_of_the_bootstrap_over_users(spark, sample_feed, tmp_path):
    keep_days(sample_feed, str(tmp_path), FIRST, LAST, (1, 2), reps=400)
    kept = bootstrap(spark, str(tmp_path), FIRST, LAST)
    users = experiments.user_ctr(sample_feed, FIRST, LAST, (1, 2))
    usual = experiments.poisson_bootstrap(users, 1, 2, reps=400)
    stats = [
        {r.exp_group: (r.m, r.s) for r in df.groupBy("exp_group").agg(F.avg("ctr").alias("m"), F.stddev("ctr").alias("s")).collect()}
        for df in (kept, usual)
    ]
    for group in (1, 2):
        (m, s), (want_m, want_s) = stats[0][group], stats[1][group]
        assert abs(m - want_m) < want_s / 2 and 0.75 < s / want_s < 1.33
    assert experiments.bootstrap_summary(kept, 1, 2).first().replicates == 400


def test_units_add_up(sample_feed):
    """With weights of 1, the sums are the counts: units lose no user."""
    feed = sample_feed.where(F.to_date("time").between(F.lit(FIRST), F.lit(LAST)) & F.col("exp_group").isin(1, 2))
    units = feed.groupBy(kept_bootstrap.unit_of(F.col("user_id"), 16).alias("u")).count()
    assert units.agg(F.sum("count")).first()[0] == feed.count() and 10 < units.count() <= 16


def test_nothing_and_nobody(spark, make_feed, tmp_path):
    feed = make_feed((None, "view", "2024-01-22", {"exp_group": 1}), (7, "view", "2024-01-22", {"exp_group": 3}))
    keep_days(feed, str(tmp_path), FIRST, FIRST, (1, 2), reps=5)
    assert bootstrap(spark, str(tmp_path), FIRST, FIRST).count() == 0
