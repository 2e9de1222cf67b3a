from datetime import date, datetime

import pandas as pd
import pytest

from feedpulse.operators import alerts

START = datetime(2024, 1, 30)


def series(spark, values, minutes=None):
    at = [pd.Timestamp(START) + pd.Timedelta(minutes=15 * i) for i in (minutes or range(len(values)))]
    rows = [(t.date(), t.strftime("%H:%M"), v, 2 * v, 5) for t, v in zip(at, values)]
    return spark.createDataFrame(rows, "date date, minutes string, dau long, likes long, views long")


def quartile(six, share):
    """Between the two neighbours in order, by distance."""
    ordered = sorted(six)
    below = int(share * (len(six) - 1))
    part = share * (len(six) - 1) - below
    return ordered[below] + part * (ordered[min(below + 1, len(six) - 1)] - ordered[below])


def looped_bands(values, a=4, n=6):
    """(low, high) for every place, None without a full window before any of its neighbours."""
    raw = [None] * n
    for i in range(n, len(values)):
        q25, q75 = (quartile(values[i - n : i], share) for share in (0.25, 0.75))
        raw.append((q25 - a * (q75 - q25), q75 + a * (q75 - q25)))
    out = []
    for i in range(len(values)):
        around = [x for x in raw[max(0, i - n // 2) : i + (n - 1) // 2 + 1] if x]
        out.append(tuple(sum(x[k] for x in around) / len(around) for k in (0, 1)) if around else (None, None))
    return out


VALUES = [5, 7, 6, 9, 4, 8, 7, 40, 6, 5, 9, 8, 3, 7, 8, 30]


@pytest.mark.parametrize("n", [3, 5, 6])
def test_bands_equal_a_plain_loop(spark, n):
    bands = alerts.iqr_bands(series(spark, VALUES), ["dau"], n=n).orderBy("date", "minutes").collect()
    for row, want in zip(bands, looped_bands(VALUES, n=n), strict=True):
        assert (row.low, row.high) == pytest.approx(want)


def test_no_band_before_n_buckets(spark):
    bands = alerts.iqr_bands(series(spark, VALUES[:6]))
    assert bands.where("q25 IS NOT NULL OR low IS NOT NULL").count() == 0
    assert alerts.anomaly_alerts(bands).count() == 0


def test_alert_row(spark):
    row = alerts.anomaly_alerts(alerts.iqr_bands(series(spark, VALUES), ["dau"])).collect()
    assert [(r.metric, r.minutes, r.value, r.previous, r.deviation) for r in row] == [
        ("dau", "03:45", 30.0, 8.0, 275.0)
    ]


def test_constant_metric_is_not_an_anomaly_but_any_change_is(spark):
    # The band of a constant series has no width; being on its edge is not outside.
    constant = series(spark, [5] * 8 + [6])
    found = alerts.anomaly_alerts(alerts.iqr_bands(constant)).collect()
    assert {r.metric for r in found} == {"dau", "likes"}


def test_deviation_without_previous_value(spark):
    zero_before = alerts.anomaly_alerts(alerts.iqr_bands(series(spark, [1, 0, 4])), flagged_only=False)
    assert {r.metric: r.deviation for r in zero_before.collect()}["dau"] is None
    single = alerts.anomaly_alerts(alerts.iqr_bands(series(spark, [4])), flagged_only=False)
    assert {r.deviation for r in single.collect()} == {None}


def test_backtest_equals_checking_each_prefix(spark):
    history = alerts.anomaly_backtest(series(spark, VALUES)).collect()
    judged = {(r.metric, r.minutes): (r.is_alert, r.low, r.high) for r in history}
    for size in (1, 7, 8, 10, 16):
        prefix = alerts.iqr_bands(series(spark, VALUES[:size]))
        for r in alerts.anomaly_alerts(prefix, flagged_only=False).collect():
            assert judged[r.metric, r.minutes] == (r.is_alert, r.low, r.high)


def test_a_decision_needs_no_more_than_the_context_rows(spark):
    whole = {(r.metric, r.minutes): r for r in alerts.anomaly_backtest(series(spark, VALUES)).collect()}
    last = VALUES[-alerts.context_rows() - 1 :]
    skipped = range(len(VALUES) - len(last), len(VALUES))
    for r in alerts.anomaly_backtest(series(spark, last, list(skipped))).collect():
        if r.minutes == "03:45":
            assert r == whole[r.metric, r.minutes]


def test_buckets_up_to_the_last_closed_one(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-28 23:59"),
        (1, "view", "2024-01-29 00:00"),
        (2, "like", "2024-01-29 00:14"),
        (1, "like", "2024-01-29 00:14"),
        (1, "view", "2024-01-30 17:59"),
        (1, "view", "2024-01-30 18:00"),
    )
    got = alerts.activity_15min(feed, datetime(2024, 1, 30, 18, 7)).collect()
    assert [tuple(r) for r in got] == [
        (date(2024, 1, 29), "00:00", 2, 2, 1),
        (date(2024, 1, 30), "17:45", 1, 0, 1),
    ]


def test_gaps_are_filled_only_on_request(make_feed):
    feed = make_feed((1, "view", "2024-01-29 23:50"), (1, "like", "2024-01-30 00:20"))
    at = datetime(2024, 1, 30, 18, 7)
    assert [r.minutes for r in alerts.activity_15min(feed, at).collect()] == ["23:45", "00:15"]
    filled = alerts.activity_15min(feed, at, fill=True).collect()
    assert [tuple(r)[1:] for r in filled] == [("23:45", 1, 0, 1), ("00:00", 0, 0, 0), ("00:15", 1, 1, 0)]


def test_full_series_has_both_services(make_feed, make_messages):
    feed = make_feed((1, "view", "2024-01-30 01:00"), (1, "like", "2024-01-30 01:01"))
    msg = make_messages((1, 2, "2024-01-30 01:02"), (3, 2, "2024-01-30 02:00"))
    got = alerts.activity_15min_full(feed, msg, datetime(2024, 1, 30, 18, 7)).collect()
    assert [tuple(r)[1:] for r in got] == [
        ("01:00", 1, 1, 1, 100.0, 1, 1),
        ("02:00", 0, 0, 0, None, 1, 1),
    ]
    bands = alerts.iqr_bands(
        alerts.activity_15min_full(feed, msg, datetime(2024, 1, 30, 18, 7)), alerts.ALL_METRICS
    )
    assert bands.count() == 2 * len(alerts.ALL_METRICS)
