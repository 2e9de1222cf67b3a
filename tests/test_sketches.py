import pytest
from pyspark.sql import functions as F

from feedpulse.operators import retention, sketches
from oracle import sample

DIMENSIONS = ("os", "source")


def by_key(df, value):
    return {tuple(r[k] for k in sketches.KEYS): r[value] for r in df.collect()}


@pytest.fixture(scope="module")
def many(spark):
    """40,000 users over ten days, each active on days that depend on the id."""
    return spark.range(40_000).select(
        F.col("id").alias("user_id"),
        F.explode(F.expr("filter(sequence(0, 9), d -> pmod(hash(id, d), 4) = 0 OR d = id % 10)")).alias("d"),
    ).select(
        "user_id",
        F.expr("timestamp'2024-01-01 10:00:00' + make_dt_interval(d)").alias("time"),
        F.expr("CASE WHEN user_id % 3 = 0 THEN 'iOS' WHEN user_id % 3 = 1 THEN 'Android' END").alias("os"),
        F.lit("ads").alias("source"),
    )


@pytest.mark.parametrize("kind", ["theta", "hll"])
@pytest.mark.parametrize("lg_k", [8, 10, 12])
def test_estimates_are_within_the_bound(many, kind, lg_k):
    daily = sketches.daily_sketches(many, DIMENSIONS, lg_k, kind)
    got = by_key(sketches.users_in_window(daily, lg_k=lg_k, kind=kind), "estimate")
    want = by_key(sketches.exact_users_in_window(many, DIMENSIONS), "users")
    assert set(got) == set(want)
    error = sketches.SIGMAS * sketches.relative_error(lg_k, kind)
    assert all(abs(got[k] - want[k]) <= error * want[k] for k in want)
    assert any(got[k] != want[k] for k in want)


@pytest.mark.parametrize("kind", ["theta", "hll"])
def test_a_union_of_days_is_the_ranges_sketch(many, kind):
    """Whatever order and however grouped: days, then weeks, or all at once."""
    _, _, estimate = sketches._DISTINCT[kind]
    daily = sketches.daily_sketches(many, (), kind=kind).where("dimension = 'all'")
    whole = sketches.daily_sketches(many.withColumn("time", F.lit("2024-01-01").cast("timestamp")), (), kind=kind)
    want = whole.select(estimate("users")).first()[0]
    assert sketches.united(daily, "dimension", kind=kind).select(estimate("users")).first()[0] == want
    halves = sketches.united(daily.withColumn("half", F.dayofmonth("date") % 2), "dimension", "half", kind=kind)
    assert sketches.united(halves, "dimension", kind=kind).select(estimate("users")).first()[0] == want


def test_few_users_are_exact(sample_feed):
    daily = sketches.daily_sketches(sample_feed, DIMENSIONS)
    got = by_key(sketches.users_in_window(daily), "estimate")
    assert got == by_key(sketches.exact_users_in_window(sample_feed, DIMENSIONS), "users")
    last = max(k[0] for k in got)
    weekly = by_key(sketches.users_in_window(daily, step=7), "estimate")
    assert weekly == {k: v for k, v in got.items() if (last - k[0]).days % 7 == 0}


def test_missing_values_and_users(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-01", {"os": None}), (2, "view", "2024-01-02", {"os": None}), (None, "view", "2024-01-02"),
    )
    got = by_key(sketches.users_in_window(sketches.daily_sketches(feed, ("os",)), n=2), "estimate")
    assert {(k[0].day, k[2]): v for k, v in got.items()} == {
        (1, "all"): 1, (1, "unknown"): 1, (2, "all"): 2, (2, "unknown"): 2,
    }
    none = sketches.daily_sketches(feed.limit(0))
    assert sketches.users_in_window(none).count() == 0
    assert sketches.weekly_status_estimate(none, sample.AS_OF).count() == 0


def test_weekly_status_by_set_operations(many, sample_feed):
    exact = retention.weekly_activity_status(sample_feed, sample.AS_OF)
    got = sketches.weekly_status_estimate(sketches.daily_sketches(sample_feed, ()), sample.AS_OF).drop("active")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.collect()))
    for lg_k in (9, 12):
        estimates = sketches.weekly_status_estimate(sketches.daily_sketches(many, (), lg_k), sample.AS_OF, lg_k)
        found = {(r.week, r.status): (r.num_users, r.active) for r in estimates.collect()}
        for r in retention.weekly_activity_status(many, sample.AS_OF).collect():
            estimate, active = found[r.week, r.status]
            assert abs(estimate - r.num_users) <= sketches.SIGMAS * sketches.relative_error(lg_k) * active


@pytest.fixture(scope="module")
def values(spark):
    return spark.range(60_000).selectExpr(
        "id % 2 AS g", "id % 30 AS day", "CASE WHEN id % 100 <> 7 THEN pow(rand(5), 3) * 10 END AS v"
    ).cache()


@pytest.mark.parametrize("k", [100, 400])
def test_quantiles_have_about_the_asked_rank(values, k):
    daily = sketches.daily_quantile_sketches(values, "v", "g", "day", k=k)
    asked = sketches.quantiles(daily, (0.01, 0.25, 0.5, 0.9, 0.99), "g", k=k)
    ranks = sketches.rank_of(values, "v", asked, "g").collect()
    assert len(ranks) == 10
    error = 1.5 * sketches.rank_error(k)  # the error holds for 99 % of sketches
    assert all(r.below - error <= r.p <= r.up_to + error for r in ranks)
    counts = {r.g: r["count"] for r in values.where("v IS NOT NULL").groupBy("g").count().collect()}
    assert {(r.g, r.n) for r in asked.collect()} == set(counts.items())


def test_order_of_merging_does_not_matter(values):
    daily = sketches.daily_quantile_sketches(values, "v", "g", "day")
    error = 2 * sketches.rank_error()
    for part in ("day", "day % 5", "-day"):
        again = daily.groupBy("g", F.expr(part).alias("part")).agg(
            F.kll_merge_agg_double("sketch", F.lit(sketches.KLL_K)).alias("sketch"), F.sum("n").alias("n")
        )
        ranks = sketches.rank_of(values, "v", sketches.quantiles(again, (0.5,), "g"), "g").collect()
        assert all(abs(r.up_to - 0.5) <= error for r in ranks)


def test_bins_hold_about_as_many_each(values):
    daily = sketches.daily_quantile_sketches(values, "v", "g", "day")
    bins = sketches.equal_bins(daily, 10, "g").collect()
    assert len(bins) == 20
    by_bin = {(r.g, r.bin): r for r in bins}
    assert all(by_bin[g, i].high == by_bin[g, i + 1].low for g in (0, 1) for i in range(9))
    inside = values.join(sketches.equal_bins(daily, 10, "g"), "g").where("v >= low AND v < high")
    counts = [r["count"] for r in inside.groupBy("g", "bin").count().collect()]
    n = sum(counts) / 20
    assert len(counts) == 20 and max(abs(c - n) for c in counts) < 10 * n * 4 * sketches.rank_error()


def test_few_values_are_exact(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 1.0), (1, 2.0), (2, None)], "g long, v double")
    asked = sketches.quantiles(sketches.daily_quantile_sketches(df, "v", "g"), (0.0, 0.5, 1.0), "g")
    assert [(r.g, r.n, r.quantile) for r in asked.orderBy("p").collect()] == [(1, 3, 1.0), (1, 3, 2.0), (1, 3, 3.0)]
