"""A/A and A/B experiments: per-user CTR, Welch tests, resampling, bootstrap, linearization.

Per-user tables stay distributed throughout. What leaves an operator is one row
per group, replicate or iteration, except where a per-user result is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedpulse.functions.dates import on_days
from feedpulse.functions.draws import draw_key, poisson, sample_indices, uniform
from feedpulse.functions.measures import likes, ratio, views
from feedpulse.functions.student import two_sided_p, welch

# Number of pieces a group's users are numbered in, a power of two; fixed, so that
# the numbering does not depend on the cluster.
NUMBERING_BUCKETS = 4_096
# Users with equal counts that share one bootstrap weight.
ALIKE = 16


def _slots(spark: SparkSession) -> int:
    """Number of tasks for work whose size Spark cannot see from its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def user_ctr(
    feed: DataFrame, start: date, end: date, groups: Sequence[int] | None = None
) -> DataFrame:
    """Likes, views and CTR per experiment group and user; CTR is NULL without views."""
    events = on_days(feed, start, end)
    if groups is not None:
        events = events.where(F.col("exp_group").isin(list(groups)))
    counts = events.groupBy("exp_group", "user_id").agg(likes(), views())
    return counts.withColumn("ctr", ratio(F.col("likes"), F.col("views")))


def group_counts(uc: DataFrame) -> DataFrame:
    """Number of non-NULL values of each column per group."""
    columns = [c for c in uc.columns if c != "exp_group"]
    return uc.groupBy("exp_group").agg(*[F.count(c).alias(f"n_{c}") for c in columns])


def split_moved_users(feed: DataFrame, start: date, end: date) -> DataFrame:
    """Users seen in more than one group; a sound splitter leaves this empty."""
    pairs = on_days(feed, start, end).select("user_id", "exp_group").distinct()
    by_user = pairs.groupBy("user_id").agg(F.count("exp_group").alias("n_groups"))
    return by_user.where(F.col("n_groups") > 1)


def split_consistency(feed: DataFrame, start: date, end: date) -> DataFrame:
    """Per group: users, and how many of them were also seen in another group."""
    pairs = on_days(feed, start, end).select("user_id", "exp_group").distinct()
    n_groups = F.count("exp_group").over(Window.partitionBy("user_id"))
    return (
        pairs.withColumn("n_groups", n_groups)
        .groupBy("exp_group")
        .agg(
            F.count("user_id").alias("users"),
            F.count_if(F.col("n_groups") > 1).alias("moved_users"),
        )
    )


def pooled_ctr(uc: DataFrame, digits: int | None = 3) -> DataFrame:
    """All likes of a group over all its views."""
    sums = uc.groupBy("exp_group").agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    ctr = ratio(F.col("likes"), F.col("views"))
    return sums.withColumn("ctr", ctr if digits is None else F.round(ctr, digits))


def welch_ttest(
    df: DataFrame, group_col: str, value_col: str, a: int, b: int, by: Sequence[str] = ()
) -> DataFrame:
    """Unequal-variance t-test of ``value_col`` between groups a and b.

    One row, or one per combination of the ``by`` columns. NULL values are left
    out and ``n_a``/``n_b`` tell how many remained.
    """
    moments = []
    for side, group in (("a", a), ("b", b)):
        value = F.when(F.col(group_col) == group, F.col(value_col))
        moments += [
            F.count(value).alias(f"n_{side}"),
            F.avg(value).alias(f"mean_{side}"),
            F.var_samp(value).alias(f"var_{side}"),
        ]
    grouped = df.groupBy(*by).agg(*moments)
    t, dof = welch(*[F.col(f"{m}_{side}") for side in "ab" for m in ("n", "mean", "var")])
    return grouped.withColumns({"t_stat": t, "dof": dof}).select(
        *by,
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        "n_a",
        "n_b",
        "mean_a",
        "mean_b",
        "t_stat",
        "dof",
        two_sided_p(F.col("t_stat"), F.col("dof")).alias("p_value"),
    )


def _bucketed(uc: DataFrame) -> DataFrame:
    # A bit mask, unlike a modulo, is known not to be NULL, which spares the joins a filter
    # that would keep Spark from recognising equal shuffles.
    bucket = draw_key(F.col("user_id")).bitwiseAND(F.lit(NUMBERING_BUCKETS - 1)).alias("bucket")
    return uc.select("exp_group", "user_id", "ctr", bucket)


def _bucket_sizes(users: DataFrame) -> DataFrame:
    """Users per group and bucket: ``NUMBERING_BUCKETS`` rows per group at most.

    Counting users with and without a CTR separately reads the same columns as
    the numbering does, so that Spark runs the per-user aggregation only once.
    """
    ctr = F.col("ctr")
    size = F.count_if(ctr.isNull()) + F.count_if(ctr.isNotNull())
    return users.groupBy("exp_group", "bucket").agg(size.alias("size"))


def _numbered(users: DataFrame, sizes: DataFrame) -> DataFrame:
    """Number each group's users 0..N-1 without putting a group into one task.

    Users are numbered within hash buckets; a bucket starts where the smaller
    ones end. Only the small table of starts is broadcast.
    """
    smaller = (
        Window.partitionBy("exp_group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("size").over(smaller), F.lit(0)).alias("start")
    within = Window.partitionBy("exp_group", "bucket").orderBy("user_id")
    return (
        users.withColumn("position", F.row_number().over(within) - 1)
        .join(F.broadcast(sizes.select("exp_group", "bucket", start)), ["exp_group", "bucket"])
        .select("exp_group", (F.col("start") + F.col("position")).alias("position"), "ctr")
    )


def aa_resample(
    uc: DataFrame, a: int, b: int, n: int = 250, iters: int = 10_000, seed: int = 42
) -> DataFrame:
    """Welch test between n users of either group, drawn anew in every iteration.

    Users are drawn without replacement. The draws are made on positions, so an
    iteration costs n rows per group however large the groups are, and are then
    joined to the numbered users. A group of fewer than n users is an error.
    """
    spark = uc.sparkSession
    users = _bucketed(uc.where(F.col("exp_group").isin(a, b)))
    bucket_sizes = _bucket_sizes(users)
    # Two rows. A group without any user has none and is given the size 0 below.
    sizes = bucket_sizes.groupBy("exp_group").agg(F.sum("size").alias("size"))
    cells = spark.range(0, iters, 1, _slots(spark)).select(
        F.col("id").alias("iteration"),
        F.explode(F.array(F.lit(a), F.lit(b))).alias("exp_group"),
    )
    size = F.coalesce("size", F.lit(0).cast("long"))
    chosen = sample_indices(size, n, F.lit(seed), F.col("iteration"), F.col("exp_group"))
    draws = cells.join(F.broadcast(sizes), "exp_group", "left").select(
        "iteration", "exp_group", F.explode(chosen).alias("position")
    )
    # Both sides are shuffled by position, where every key holds one user. The hash table is
    # built of the draws, whose number is fixed; the users, however many, are streamed.
    drawn = _numbered(users, bucket_sizes).join(
        draws.hint("shuffle_hash"), ["exp_group", "position"]
    )
    return welch_ttest(drawn, "exp_group", "ctr", a, b, by=["iteration"])


def aa_pass_rate(pvalues: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Percentage of iterations whose p-value exceeds alpha."""
    passed, iterations = F.count_if(F.col("p_value") > alpha), F.count("*")
    return pvalues.agg(
        iterations.alias("iterations"), F.round(ratio(passed * 100, iterations), 2).alias("percent")
    )


def metric_histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts of ``col`` in equal-width bins from its minimum to its maximum, per ``by`` value.

    The last bin includes the maximum. Empty bins are absent; NULLs are left out.
    """
    keys = [] if by is None else [by]
    values = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("value"))
    extent = values.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high")))
    low, high = F.col("extent")["low"], F.col("extent")["high"]
    width = (high - low) / bins
    place = F.floor(ratio(F.col("value") - low, high - low) * bins)
    numbered = values.withColumn("extent", extent.scalar()).select(
        *keys,
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin"),
        low.alias("low"),
        width.alias("width"),
    )
    return numbered.groupBy(*keys, "bin", "low", "width").agg(F.count("*").alias("count")).select(
        *keys,
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "count",
    )


def poisson_bootstrap(
    uc: DataFrame, a: int, b: int, reps: int = 2_000, seed: int = 42
) -> DataFrame:
    """Pooled CTR of either group with Poisson(1) user weights, for every replicate.

    Users of a group with equal likes and views are interchangeable, and the sum
    of m such weights is a Poisson(m) one. So users are counted by (group, likes,
    views) first; ``ALIKE`` of them at a time get one weight, and those left over one each.
    What is drawn thus grows with the different counts, and by a small part with
    the users. A weight is a hash of (seed, group, likes, views, how many, which, replicate).

    The weighted rows exist only inside the map side of the aggregation; what is
    shuffled is one partial sum per task, replicate and group. They are spread over all tasks
    by their key before they are expanded, since the table of counts alone
    may be small enough for Spark to merge it into a few partitions.
    """
    users = uc.where(F.col("exp_group").isin(a, b)).groupBy("exp_group", "likes", "views")
    counted = users.agg(F.count("*").alias("users"))

    def parts(size: int, number: Column) -> Column:
        one = lambda i: F.struct(F.lit(size).alias("size"), i.alias("which"))
        return F.filter(F.transform(F.sequence(F.lit(0).cast("long"), number), one), lambda x: x["which"] < number)

    together, rest = F.floor(F.col("users") / ALIKE), F.col("users") % ALIKE
    part = F.explode(F.concat(parts(ALIKE, together), parts(1, rest)))
    weighted_by = draw_key(
        F.lit(seed), *[F.col(c) for c in ("exp_group", "likes", "views", "size", "which")]
    )
    drawn = counted.select("exp_group", "likes", "views", part.alias("part")).select(
        "exp_group", "likes", "views", "part.*"
    )
    spread = drawn.withColumn("key", weighted_by).repartition(_slots(uc.sparkSession), "key")
    replicates = F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("replicate")
    u = uniform(F.col("key"), F.col("replicate"))
    weight = F.when(F.col("size") == 1, poisson(u, 1)).otherwise(poisson(u, ALIKE))
    weighted = spread.select("exp_group", "likes", "views", "size", "key", replicates).withColumn("weight", weight)
    sums = weighted.groupBy("replicate", "exp_group").agg(
        F.sum(F.col("weight") * F.col("likes")).alias("likes"),
        F.sum(F.col("weight") * F.col("views")).alias("views"),
    )
    return sums.select("replicate", "exp_group", ratio(F.col("likes"), F.col("views")).alias("ctr"))


def bootstrap_summary(boot: DataFrame, a: int, b: int) -> DataFrame:
    """Means, 95 % intervals, how often b beats a, and the interval of the difference."""

    def of(group: int) -> Column:
        return F.max(F.when(F.col("exp_group") == group, F.col("ctr")))

    pairs = boot.groupBy("replicate").agg(of(a).alias("ctr_a"), of(b).alias("ctr_b"))
    pairs = pairs.withColumn("diff", F.col("ctr_b") - F.col("ctr_a"))
    columns = [F.count("*").alias("replicates")]
    for name, label in (("ctr_a", "a"), ("ctr_b", "b"), ("diff", "diff")):
        columns += [
            F.avg(name).alias(f"mean_{label}"),
            F.percentile(name, F.lit(0.025)).alias(f"low_{label}"),
            F.percentile(name, F.lit(0.975)).alias(f"high_{label}"),
        ]
    wins = ratio(F.count_if(F.col("diff") > 0), F.count("diff")).alias("share_b_above_a")
    return pairs.agg(*columns, wins)


def linearized_likes(uc: DataFrame, control: int) -> DataFrame:
    """Add ``linearized_likes`` = likes - CTR of the control group * views.

    The control CTR is a single value, attached as a scalar subquery. It is taken
    from all of ``uc`` with a condition, so that Spark sees the same per-user
    aggregation on both sides and runs it once.
    """

    def of_control(column: str) -> Column:
        return F.sum(F.when(F.col("exp_group") == control, F.col(column)))

    pooled = uc.agg(ratio(of_control("likes"), of_control("views")).alias("ctr"))
    value = F.col("likes") - F.col("control_ctr") * F.col("views")
    return (
        uc.withColumn("control_ctr", pooled.scalar())
        .withColumn("linearized_likes", value)
        .drop("control_ctr")
    )


def linearized_ttest(uc: DataFrame, control: int, target: int) -> DataFrame:
    """Welch test on linearized likes."""
    return welch_ttest(
        linearized_likes(uc, control), "exp_group", "linearized_likes", control, target
    )
