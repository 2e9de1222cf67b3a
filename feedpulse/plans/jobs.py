"""The scheduled jobs and the experiment reports, from input tables to result tables.

Results that several parts of a report start from are stored in scratch space
first, so that the event tables are read once for them.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from feedpulse.functions.dates import days
from feedpulse.operators import (
    alerts,
    dashboards,
    day_totals,
    experiments,
    reports,
    retention,
    rollup,
    user_weeks,
)
from feedpulse.operators.rollup import dims_with_day
from feedpulse.sources.scratch import stored
from feedpulse.sources.writers import (
    daily_rollup_commit,
    daily_rollup_save,
    daily_rollup_write,
    read_dims,
    write_dims,
)

BINS = 20


def daily_rollup(
    feed: DataFrame,
    msg: DataFrame,
    as_of: date,
    path: str | None = None,
    table: str | None = None,
    dims_path: str | None = None,
    versioned_path: str | None = None,
) -> DataFrame:
    """Compute the roll-up of the day before ``as_of`` once, store it by path and/or table, hand it back.

    Under ``versioned_path`` (``daily_rollup_read`` reads it) and in a table the day is replaced at once; a
    plain path lacks it for a moment.

    Users' dimensions come from the feed history up to that day. With ``dims_path``
    they are kept there, as they were before each day: yesterday's copy and the one
    new day make today's, and the history is not read again. A missing copy of
    yesterday is an error; ``backfill_dims`` makes it from the history.
    """
    known = None
    if dims_path is not None:
        spark, yesterday = feed.sparkSession, as_of - days(1)
        today = dims_with_day(read_dims(spark, dims_path, yesterday), feed, yesterday, yesterday)
        write_dims(today, dims_path, as_of)
        known = read_dims(spark, dims_path, as_of).select("user_id", *rollup.DIMENSIONS)
    rows = stored(rollup.daily_rollup_final(feed, msg, as_of, known_dims=known), "daily-rollup")
    if path is not None:
        daily_rollup_write(rows, path, event_date=as_of - days(1))
    if versioned_path is not None:
        daily_rollup_commit(rows, versioned_path, as_of - days(1))
    if table is not None:
        daily_rollup_save(rows, table, event_date=as_of - days(1))
    return rows


def backfill_dims(feed: DataFrame, as_of: date, dims_path: str) -> None:
    """Store the dimension values of all days before ``as_of``."""
    write_dims(dims_with_day(None, feed, None, as_of - days(1)), dims_path, as_of)


def check_alerts(
    feed: DataFrame, as_of_ts: datetime, a: float = 4, n: int = 6, msg: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Alerts for the last closed bucket before ``as_of_ts``, and the bands for their charts.

    With messages, CTR, messenger users and messages sent are checked as well.
    """
    if msg is None:
        series, metrics = alerts.activity_15min(feed, as_of_ts), alerts.FEED_METRICS
    else:
        series, metrics = alerts.activity_15min_full(feed, msg, as_of_ts), alerts.ALL_METRICS
    bands = stored(alerts.iqr_bands(series, metrics, a, n), "bands")
    return {"alerts": alerts.anomaly_alerts(bands), "bands": bands}


def weekly_report(feed: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """New, retained and gone users by week, and the cohorts of both sources."""
    results = {"status": retention.weekly_activity_status(feed, as_of)}
    for source, digits in (("ads", 1), ("organic", 2)):
        results[f"retention_{source}"] = retention.weekly_retention(feed, source)
        results[f"percent_{source}"] = retention.weekly_retention_percent(feed, source, digits)
    return results


def weekly_report_kept(feed: DataFrame, as_of: date, path: str, first: date | None = None) -> dict[str, DataFrame]:
    """``weekly_report`` from the state kept under ``path``, after bringing in the week of the day before ``as_of``.

    Only that week's events are read; ``first`` brings in all weeks from there, to begin with
    or for events that came late.
    """
    yesterday = as_of - days(1)
    user_weeks.extend(feed, path, first or yesterday, yesterday)
    state = user_weeks.read_state(feed.sparkSession, path)
    results = {"status": user_weeks.activity_status(state, as_of)}
    for source, digits in (("ads", 1), ("organic", 2)):
        counts = user_weeks.cohort_sizes(state, source)
        results[f"retention_{source}"] = counts
        results[f"percent_{source}"] = retention.as_percent(counts, digits)
    return results


def dashboard_tables(feed: DataFrame, msg: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """What the three dashboards show."""
    return {
        "comparison": dashboards.operational_comparison(feed, msg, as_of),
        "audience": dashboards.audience_breakdown(feed),
        "overlap": dashboards.service_overlap_daily(feed, msg),
    }


def dashboard_days(feed: DataFrame, msg: DataFrame, as_of: date, path: str) -> dict[str, DataFrame]:
    """The tables over all days, from the daily totals kept under ``path``, after rebuilding the days
    marked by ``day_totals.mark_dirty``."""
    day_totals.refresh(feed, msg, path)
    totals = day_totals.read_totals(feed.sparkSession, path)
    return {"activity": day_totals.activity_change(totals, as_of), "overlap": day_totals.service_overlap(totals)}


def feed_report(feed: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """The feed report: one row of key values and the week's series for the charts."""
    daily = stored(reports.feed_daily_metrics(feed, as_of), "feed-daily")
    return {"row": reports.feed_report_row(daily), "daily": daily}


def service_report(feed: DataFrame, msg: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """The whole-service report: eight key values and the series behind its charts."""
    dau = reports.dau_by_service(feed, msg, as_of)
    new_users = stored(reports.new_users_by_source(feed, msg, as_of), "new-users")
    activity = reports.activity_change_daily(feed, msg, as_of)
    return {
        "rows": reports.service_report_row(dau, new_users, activity),
        "growth": reports.service_growth_series(new_users),
        "new_users": new_users,
        "shares": reports.traffic_shares(feed, as_of),
    }


def campaign_report(feed: DataFrame, cohort_date: date) -> dict[str, DataFrame]:
    """Retention of one day's cohort, and of the cohorts of the days around it."""
    counts = retention.campaign_daily_retention(feed, cohort_date)
    return {
        "retention": retention.campaign_retention_share(counts),
        "neighbours": retention.campaign_vs_neighbours(feed, cohort_date),
    }


def aa_report(
    feed: DataFrame,
    start: date,
    end: date,
    a: int,
    b: int,
    n: int = 250,
    iters: int = 10_000,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """A/A check of two groups: resampled p-values, pass rate, users who changed group."""
    uc = stored(experiments.user_ctr(feed, start, end, [a, b]), "user-ctr")
    pvalues = stored(experiments.aa_resample(uc, a, b, n, iters, seed), "aa-pvalues")
    return {
        "counts": experiments.group_counts(uc),
        "split": experiments.split_consistency(feed, start, end),
        "pvalues": pvalues,
        "pass_rate": experiments.aa_pass_rate(pvalues),
        "histogram": experiments.metric_histogram(pvalues, "p_value", BINS),
    }


def ab_report(
    feed: DataFrame,
    start: date,
    end: date,
    control: int,
    target: int,
    reps: int = 2_000,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """A/B comparison: pooled CTR, Welch test, Poisson bootstrap and linearized likes."""
    uc = stored(experiments.user_ctr(feed, start, end, [control, target]), "user-ctr")
    boot = stored(experiments.poisson_bootstrap(uc, control, target, reps, seed), "bootstrap")
    linearized = experiments.linearized_likes(uc, control)
    return {
        "counts": experiments.group_counts(uc),
        "pooled": experiments.pooled_ctr(uc),
        "ttest": experiments.welch_ttest(uc, "exp_group", "ctr", control, target),
        "bootstrap": experiments.bootstrap_summary(boot, control, target),
        "linearized": experiments.linearized_ttest(uc, control, target),
        "ctr_histogram": experiments.metric_histogram(uc, "ctr", BINS, "exp_group"),
        "bootstrap_histogram": experiments.metric_histogram(boot, "ctr", BINS, "exp_group"),
        "linearized_histogram": experiments.metric_histogram(
            linearized, "linearized_likes", BINS, "exp_group"
        ),
    }
