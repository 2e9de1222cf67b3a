import random

import pytest
from pyspark.sql import functions as F

from feedpulse.operators import alerts
from feedpulse.streaming import bands
from tests.test_both_services import SINCE, Arrivals


@pytest.fixture(scope="module")
def recent(sample_feed, sample_messages):
    return sample_feed.where(SINCE), sample_messages.where(SINCE)


def by_bucket(df):
    rows = df.collect()
    out = {(r.metric, r.date, r.minutes): r for r in rows}
    assert len(out) == len(rows)
    return out


def same(got, want):
    exact = ("value", "previous", "deviation", "is_alert")
    near = [(got[c], want[c]) for c in ("low", "high")]
    return all(got[c] == want[c] for c in exact) and all(x is y or x == pytest.approx(y) for x, y in near)


@pytest.mark.parametrize("fill", [False, True])
def test_state_over_restarts_equals_the_backtest(spark, recent, tmp_path, fill):
    feed, msg = recent
    arrivals = Arrivals(spark, str(tmp_path / "in"), feed, msg)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for day in (28, 29, 30):
        on_day = F.dayofmonth("time") == day
        arrivals.add("feed_actions", feed.where(on_day))
        arrivals.add("message_actions", msg.where(on_day))
        bands.alerts_to_table(
            *arrivals.streams(), out, checkpoint, flagged_only=False, a=0.5, fill=fill
        ).awaitTermination()
    got = spark.read.parquet(out)
    last = got.agg(F.max(F.struct("date", "minutes"))).first()[0]
    series = alerts.full_series(feed, msg).where(F.struct("date", "minutes") <= F.struct(F.lit(last[0]), F.lit(last[1])))
    if fill:
        series = alerts.fill_gaps(series, alerts.ALL_METRICS)
    want = alerts.anomaly_backtest(series, alerts.ALL_METRICS, a=0.5)
    got_rows, want_rows = by_bucket(got), by_bucket(want)
    assert set(got_rows) == set(want_rows)
    assert [k for k in want_rows if not same(got_rows[k], want_rows[k])] == []
    assert got.where("is_alert").count() > 5


def test_quantiles_between_values():
    assert bands.quantile([4, 1, 3, 2], 0.25) == 1.75 and bands.quantile([5], 0.75) == 5
    values = [random.Random(1).random() for _ in range(6)]
    assert bands.raw_band(values[:5], 4, 6) is None and bands.raw_band([*values[:5], None], 4, 6) is None
    low, high = bands.raw_band(values, 0, 6)
    assert low == bands.quantile(values, 0.25) and high == bands.quantile(values, 0.75)
