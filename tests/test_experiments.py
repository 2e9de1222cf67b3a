import math
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedpulse.functions.draws import poisson, sample_indices, uniform
from feedpulse.functions.student import two_sided_p
from feedpulse.operators import experiments as ex

WEEK = (date(2024, 1, 22), date(2024, 1, 28))


def users(spark, n, shift=0.0, groups=(0, 1)):
    """A per-user table whose groups differ by ``shift`` in CTR."""
    ids = spark.range(n * len(groups))
    group = F.element_at(F.array(*[F.lit(g) for g in groups]), (F.col("id") % len(groups) + 1).cast("int"))
    views = F.lit(100).cast("long")
    likes = F.floor(uniform(F.col("id"), F.lit(7)) * 60 + F.when(group == groups[1], shift).otherwise(0))
    return ids.select(
        group.cast("int").alias("exp_group"),
        F.col("id").alias("user_id"),
        likes.alias("likes"),
        views.alias("views"),
        (likes / views).alias("ctr"),
    )


def t_tail(t, dof):
    """Exact two-sided p for an odd or even integer dof, from the finite series."""
    theta = math.atan(t / math.sqrt(dof))
    c, s = math.cos(theta), math.sin(theta)
    term, total = (c, 0.0) if dof % 2 else (1.0, 0.0)
    for k in range(2 if dof % 2 else 1, dof, 2):
        total += term
        term *= c * c * k / (k + 1)
    inside = 2 / math.pi * (theta + s * total) if dof % 2 else s * total
    return 1 - inside


def test_p_value_against_the_finite_series(spark):
    cases = [(t, d) for t in (0.0, 0.1, 1.0, 2.0, 3.5, 8.0) for d in (1, 2, 3, 7, 30, 57, 58, 120, 499)]
    df = spark.createDataFrame([(t, float(d)) for t, d in cases], "t double, d double")
    for r in df.select("t", "d", two_sided_p(F.col("t"), F.col("d")).alias("p")).collect():
        assert r.p == pytest.approx(t_tail(r.t, int(r.d)), abs=1e-9), (r.t, r.d)


def small_tail(t, dof):
    """Two-sided p of a large t by Simpson's rule on the density relative to its value at t, in logs."""
    log_density = lambda x: -(dof + 1) / 2 * math.log1p(x * x / dof)
    whole = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    # In x = t * exp(y), the tail falls off at least as exp(-y * dof).
    n, top = 20_000, 60 / min(dof, (dof + 1) * t * t / (dof + t * t))
    at = lambda y: math.exp(log_density(t * math.exp(y)) - log_density(t) + y) * t
    h = top / n
    total = sum((1 if i in (0, n) else 4 if i % 2 else 2) * at(i * h) for i in range(n + 1)) * h / 3
    return 2 * total * math.exp(whole + log_density(t))


def test_small_p_values_keep_their_relative_accuracy(spark):
    cases = [(8.9, 1e6), (9.5, 1e6), (21.0, 1e6), (30.0, 200.0), (12.0, 58.0), (40.0, 30.0), (200.0, 3.5), (20.0, 1e9)]
    df = spark.createDataFrame(cases, "t double, d double")
    for r in df.select("t", "d", two_sided_p(F.col("t"), F.col("d")).alias("p")).collect():
        assert r.p == pytest.approx(small_tail(r.t, r.d), rel=1e-6), (r.t, r.d)
        assert r.p > 1e-100


def test_p_value_with_fractional_dof_and_missing_input(spark):
    df = spark.sql("SELECT * FROM VALUES (1.5D, 1.3D), (-1.5D, 1.3D), (NULL, 3D), (1D, NULL) AS v(t, d)")
    p = [r.p for r in df.select(two_sided_p(F.col("t"), F.col("d")).alias("p")).collect()]
    assert p[0] == p[1] and 0.30 < p[0] < 0.42  # between dof 1 (0.374) and 2 (0.272)
    assert p[2] is None and p[3] is None


def test_ctr_per_user(make_feed):
    feed = make_feed((1, "like", "2024-01-22"), (1, "view", "2024-01-28"), (2, "like", "2024-01-25"),
                     (3, "view", "2024-01-25", {"exp_group": 4}), (1, "view", "2024-01-29"))
    uc = ex.user_ctr(feed, *WEEK, groups=[0])
    assert sorted((r.user_id, r.likes, r.views, r.ctr) for r in uc.collect()) == [(1, 1, 1, 1.0), (2, 1, 0, None)]
    assert ex.group_counts(uc).first().asDict() == {
        "exp_group": 0, "n_user_id": 2, "n_likes": 2, "n_views": 2, "n_ctr": 1,
    }
    assert ex.user_ctr(feed, *WEEK).count() == 3
    assert ex.pooled_ctr(uc).first().ctr == 2.0


def test_users_who_change_group(make_feed):
    feed = make_feed((1, "view", "2024-01-22", {"exp_group": 1}), (1, "view", "2024-01-23", {"exp_group": 2}),
                     (2, "view", "2024-01-23", {"exp_group": 2}))
    assert [tuple(r) for r in ex.split_moved_users(feed, *WEEK).collect()] == [(1, 2)]
    got = sorted(tuple(r) for r in ex.split_consistency(feed, *WEEK).collect())
    assert got == [(1, 1, 1), (2, 2, 1)]


def test_welch_by_hand(spark):
    rows = [(0, v) for v in (1.0, 2.0, 3.0, 4.0)] + [(1, v) for v in (2.0, 4.0, 6.0, None)] + [(2, 9.0)]
    r = ex.welch_ttest(spark.createDataFrame(rows, "g int, v double"), "g", "v", 0, 1).first()
    se_a, se_b = (5 / 3) / 4, 4 / 3
    assert (r.n_a, r.n_b) == (4, 3)
    assert r.t_stat == pytest.approx(-1.5 / math.sqrt(se_a + se_b))
    assert r.dof == pytest.approx((se_a + se_b) ** 2 / (se_a**2 / 3 + se_b**2 / 2))
    assert 0 < r.p_value < 1


def test_welch_without_variance(spark):
    rows = [(0, 1.0), (0, 1.0), (1, 1.0), (1, 1.0)]
    r = ex.welch_ttest(spark.createDataFrame(rows, "g int, v double"), "g", "v", 0, 1).first()
    assert r.t_stat is None and r.p_value is None


@pytest.mark.parametrize("size,n", [(1, 1), (7, 7), (10, 6), (40, 20), (500, 20), (100_000, 250)])
def test_samples_hold_n_different_indices(spark, size, n):
    chosen = sample_indices(F.lit(size).cast("long"), n, F.lit(42), F.col("id"))
    rows = spark.range(50).select(chosen.alias("chosen")).collect()
    for r in rows:
        assert len(r.chosen) == len(set(r.chosen)) == n
        assert min(r.chosen) >= 0 and max(r.chosen) < size
    if n < size:
        assert len({tuple(sorted(r.chosen)) for r in rows}) > 1


def test_every_index_is_drawn_equally_often(spark):
    for size, n in ((40, 10), (40, 30)):
        chosen = sample_indices(F.lit(size).cast("long"), n, F.lit(1), F.col("id"))
        counts = spark.range(4000).select(F.explode(chosen).alias("i")).groupBy("i").count().collect()
        expected = 4000 * n / size
        assert len(counts) == size
        assert all(abs(r["count"] - expected) < 6 * math.sqrt(expected) for r in counts)


def test_poisson_weights(spark):
    weights = spark.range(100_000).select(poisson(uniform(F.col("id")), 1).alias("w"))
    r = weights.agg(F.avg("w"), F.var_samp("w"), F.count_if(F.col("w") == 0)).first()
    assert r[0] == pytest.approx(1, abs=0.02) and r[1] == pytest.approx(1, abs=0.03)
    assert r[2] / 100_000 == pytest.approx(math.exp(-1), abs=0.01)


def test_numbering_is_gapless(spark):
    table = ex._bucketed(users(spark, 3000))
    numbered = ex._numbered(table, ex._bucket_sizes(table))
    r = numbered.groupBy("exp_group").agg(
        F.count_distinct("position").alias("n"), F.min("position"), F.max("position").alias("top")
    )
    assert sorted(tuple(x) for x in r.collect()) == [(0, 3000, 0, 2999), (1, 3000, 0, 2999)]


def test_aa_passes_on_equal_groups_and_fails_on_different_ones(spark):
    equal = ex.aa_pass_rate(ex.aa_resample(users(spark, 2000), 0, 1, n=100, iters=600)).first()
    assert equal.iterations == 600 and 92 <= equal.percent <= 98
    shifted = ex.aa_pass_rate(ex.aa_resample(users(spark, 2000, shift=15), 0, 1, n=100, iters=200)).first()
    assert shifted.percent < 10


def test_aa_is_reproducible_and_depends_on_the_seed(spark):
    def run(seed, table):
        got = ex.aa_resample(table, 0, 1, n=20, iters=20, seed=seed).collect()
        return sorted((r.iteration, round(r.p_value, 12)) for r in got)

    table = users(spark, 100)
    assert run(1, table) == run(1, table.repartition(13)) != run(2, table)


def test_sample_larger_than_a_group_is_an_error(spark):
    with pytest.raises(PySparkException, match="sample of 101 asked from a group of 100"):
        ex.aa_resample(users(spark, 100), 0, 1, n=101, iters=5).collect()
    with pytest.raises(PySparkException, match="from a group of 0"):
        ex.aa_resample(users(spark, 100), 0, 5, n=10, iters=5).collect()


def test_bootstrap_surrounds_the_pooled_ctr(spark):
    uc = users(spark, 1000, shift=10)
    pooled = {r.exp_group: r.ctr for r in ex.pooled_ctr(uc, digits=None).collect()}
    boot = ex.poisson_bootstrap(uc, 0, 1, reps=300)
    assert boot.count() == 600
    s = ex.bootstrap_summary(boot, 0, 1).first()
    assert s.low_a < pooled[0] < s.high_a and s.low_b < pooled[1] < s.high_b
    assert s.share_b_above_a == 1 and s.low_diff > 0


def test_linearized_likes_of_the_control_group_sum_to_zero(sample_feed):
    uc = ex.user_ctr(sample_feed, *WEEK, groups=[1, 2])
    total = ex.linearized_likes(uc, 1).where("exp_group = 1").agg(F.sum("linearized_likes")).first()[0]
    assert total == pytest.approx(0, abs=1e-9)
    r = ex.linearized_ttest(uc, 1, 2).first()
    assert (r.group_a, r.group_b) == (1, 2) and 0 <= r.p_value <= 1


def test_histogram(spark):
    values = spark.createDataFrame([(1, v) for v in (0.0, 0.1, 0.5, 1.0, None)], "g int, v double")
    got = [(r.g, r.bin, r["count"]) for r in ex.metric_histogram(values, "v", 2, "g").orderBy("bin").collect()]
    assert got == [(1, 0, 2), (1, 1, 2)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r["count"]) for r in ex.metric_histogram(same, "v", 4).collect()] == [(0, 2)]


def test_users_alike_share_weights(spark):
    """1,000 equal users and one who differs: the number of draws is small, the distribution that of users."""
    rows = [(g, i, 2, 10) for g in (0, 1) for i in range(1_000)] + [(0, 5_000, 900, 0)]
    uc = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long")
    boot = ex.poisson_bootstrap(uc, 0, 1, reps=2_000).toPandas()
    assert (boot[boot.exp_group == 1].ctr.round(9) == 0.2).all()
    other = (boot[boot.exp_group == 0].ctr - 0.2) * 10_000 / 900  # about Poisson(1)
    assert other.mean() == pytest.approx(1, abs=0.1) and other.var() == pytest.approx(1, abs=0.2)
