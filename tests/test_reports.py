from datetime import date

import pytest

from feedpulse.operators import dashboards, reports

AS_OF = date(2024, 1, 31)


def by_date(df):
    return {r.date.day: r.asDict() for r in df.collect()}


def test_first_day_has_no_change_and_zero_before_gives_none(make_feed, make_messages):
    feed = make_feed((1, "view", "2024-01-28"), (1, "like", "2024-01-29"), (2, "view", "2024-01-29"))
    msg = make_messages((1, 2, "2024-01-28"), (1, 2, "2024-01-29"), (1, 2, "2024-01-29"))
    got = by_date(reports.activity_change_daily(feed, msg, AS_OF))
    assert got[28]["views_change"] is None and got[28]["messages_change"] is None
    assert got[29]["likes_change"] is None  # no likes the day before
    assert (got[29]["views_change"], got[29]["messages_change"]) == (0.0, 100.0)


def test_user_of_both_services_counts_once(make_feed, make_messages):
    feed = make_feed((1, "view", "2024-01-30"), (2, "view", "2024-01-30"))
    msg = make_messages((1, 9, "2024-01-30"), (3, 9, "2024-01-30"))
    got = by_date(reports.dau_by_service(feed, msg, AS_OF))[30]
    assert (got["dau_feed"], got["dau_message"], got["dau_both"]) == (2, 2, 3)
    overlap = by_date(dashboards.service_overlap_daily(feed, msg))[30]
    assert (overlap["feed_only"], overlap["message_only"], overlap["both_services"]) == (1, 1, 1)


def test_previous_day_is_each_services_own(make_feed, make_messages):
    # No messages on the 29th: that day is left out, and the messenger compares 30 with 28.
    feed = make_feed(*[(u, "view", f"2024-01-{d}") for d, n in ((28, 1), (29, 4), (30, 2)) for u in range(n)])
    msg = make_messages((1, 9, "2024-01-28"), (1, 9, "2024-01-30"), (2, 9, "2024-01-30"))
    got = by_date(reports.dau_by_service(feed, msg, AS_OF))
    assert sorted(got) == [28, 30]
    assert got[30]["change_feed"] == -50.0
    assert got[30]["change_message"] == 100.0


def test_seven_full_days(make_feed):
    feed = make_feed(*[(1, "view", f"2024-01-{d}") for d in range(20, 32)], (1, "like", "2024-01-25"))
    daily = reports.feed_daily_metrics(feed, AS_OF)
    assert sorted(by_date(daily)) == list(range(24, 31))
    assert by_date(daily)[25]["ctr"] == 100.0
    row = reports.feed_report_row(daily).first()
    assert (row.period_start, row.period_end, row.views) == (date(2024, 1, 24), date(2024, 1, 30), 1)


def test_likes_without_views_give_no_ctr(make_feed):
    daily = reports.feed_daily_metrics(make_feed((1, "like", "2024-01-30")), AS_OF)
    assert by_date(daily)[30]["ctr"] is None


def test_new_users_are_new_within_the_window_and_per_source(make_feed, make_messages):
    feed = make_feed(
        (1, "view", "2024-01-01"),
        (1, "view", "2024-01-24"),
        (1, "view", "2024-01-25", {"source": "organic"}),
        (2, "view", "2024-01-25"),
        (1, "view", "2024-01-26"),
    )
    msg = make_messages((7, 8, "2024-01-24"), (8, 7, "2024-01-25"))
    got = by_date(reports.new_users_by_source(feed, msg, AS_OF))
    assert sorted(got) == [24, 25]
    assert (got[24]["new_ads_feed"], got[24]["new_organic_feed"]) == (1, 0)
    assert (got[25]["new_ads_feed"], got[25]["new_organic_feed"]) == (1, 1)
    assert (got[25]["total_ads_feed"], got[25]["change_feed"], got[25]["change_message"]) == (2, 100.0, 0.0)
    growth = by_date(reports.service_growth_series(reports.new_users_by_source(feed, msg, AS_OF)))
    assert (growth[25]["users_feed"], growth[25]["users_message"]) == (3, 2)


def test_shares_leave_out_incomplete_days_and_other_systems(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-29", {"os": "iOS"}),
        (2, "view", "2024-01-29", {"os": "Android"}),
        (3, "view", "2024-01-29", {"os": "Android"}),
        (4, "view", "2024-01-29", {"os": "Web", "source": "organic"}),
        (5, "view", "2024-01-29", {"os": None, "source": "organic"}),
        (1, "view", "2024-01-30", {"os": "iOS"}),
    )
    os_share = by_date(reports.os_share_daily(feed, AS_OF))
    assert list(os_share) == [29]
    assert (os_share[29]["ios_share"], os_share[29]["android_share"]) == (33.3, 66.7)
    both = by_date(reports.traffic_shares(feed, AS_OF))
    assert (both[29]["ads_share"], both[29]["organic_share"]) == (75.0, 25.0)


def test_shares_add_up(sample_feed):
    for r in reports.traffic_shares(sample_feed, AS_OF).collect():
        assert r.ios_share + r.android_share == pytest.approx(100, abs=0.11)
        assert r.ads_share + r.organic_share == pytest.approx(100, abs=0.11)


def test_report_has_eight_lines_of_the_latest_day(sample_feed, sample_messages):
    dau = reports.dau_by_service(sample_feed, sample_messages, AS_OF)
    new = reports.new_users_by_source(sample_feed, sample_messages, AS_OF)
    activity = reports.activity_change_daily(sample_feed, sample_messages, AS_OF)
    lines = {(r.section, r.metric): r.value for r in reports.service_report_row(dau, new, activity).collect()}
    assert len(lines) == 8
    assert lines["dau", "feed"] == dau.orderBy("date").tail(1)[0].dau_feed
    assert lines["activity", "messages"] == activity.orderBy("date").tail(1)[0].send_messages


def test_comparison_with_the_week_before(make_feed, make_messages):
    feed = make_feed((1, "view", "2024-01-23"), (1, "view", "2024-01-30"), (2, "view", "2024-01-30"))
    got = {
        r.metric: r
        for r in dashboards.operational_comparison(feed, make_messages((1, 2, "2024-01-30")), AS_OF).collect()
    }
    assert (got["dau_feed"].yesterday, got["dau_feed"].week_ago, got["dau_feed"].change_percent) == (2, 1, 100)
    assert got["messages"].week_ago == 0 and got["messages"].change_percent is None


def test_breakdown_counts_a_user_once_per_value(make_feed):
    feed = make_feed(
        (1, "view", "2024-01-30", {"os": "iOS"}),
        (1, "like", "2024-01-30", {"os": "Web"}),
        (1, "view", "2024-01-30", {"os": "iOS", "source": "organic"}),
    )
    got = {
        (r.dimension, r.dimension_value): (r.users, r.likes, r.views)
        for r in dashboards.audience_breakdown(feed).collect()
    }
    assert got["total", "all"] == (1, 1, 2)
    assert got["os", "iOS"] == (1, 0, 2) and got["os", "Web"] == (1, 1, 0)
    assert got["source", "ads"] == (1, 1, 1)
