from datetime import timedelta

import pytest
from conftest import events, tuples, utc

from tidewatch.operators import activity
from tidewatch.operators.rollup import compact_hourly, hourly_partials, hourly_rollup, timeseries_rows
from tidewatch.plans.dashboard import dashboard

NOW = utc(2026, 5, 8, 12, 30)


def at(hours=0, minutes=0):
    return NOW - timedelta(hours=hours, minutes=minutes)


@pytest.fixture(scope="module")
def raw(spark):
    return events(
        spark,
        [
            ("1", "PushEvent", "top/repo", "alice", at(1)),
            ("2", "PushEvent", "top/repo", "alice", at(2)),
            ("3", "IssuesEvent", "top/repo", "bob", at(3)),
            ("4", "PushEvent", "next/repo", "carol", at(1)),
            ("5", "ForkEvent", "old/repo", "dave", at(200)),
            ("6", "WatchEvent", "also/repo", "erin", at(1)),
        ],
    )


@pytest.fixture(scope="module")
def hourly(raw):
    return hourly_partials(raw)


def test_trending_counts_order_and_ties(hourly):
    assert tuples(activity.trending_repos(hourly, NOW, 24, 10)) == [("top/repo", 3), ("also/repo", 1), ("next/repo", 1)]
    assert tuples(activity.trending_repos(hourly, NOW, 24, 1)) == [("top/repo", 3)]


def test_a_bucket_that_starts_before_the_cutoff_is_dropped_whole(spark):
    rows = events(spark, [("1", "P", "r", "a", at(0, 45)), ("2", "P", "r", "a", at(0, 15))])
    # The cutoff is 11:30; the 11:00 bucket holds 11:45 and is still out.
    assert tuples(activity.trending_repos(hourly_partials(rows), NOW, 1, 10)) == [("r", 1)]


def test_future_events_count(spark):
    rows = events(spark, [("1", "P", "r", "a", NOW + timedelta(days=3))])
    assert tuples(activity.trending_repos(hourly_partials(rows), NOW)) == [("r", 1)]


def test_breakdown(hourly):
    assert tuples(activity.event_breakdown(hourly, NOW, 24)) == [("PushEvent", 3), ("IssuesEvent", 1), ("WatchEvent", 1)]


def test_empty_window_is_an_empty_result(hourly):
    later = NOW + timedelta(days=30)
    assert tuples(activity.event_breakdown(hourly, later, 24)) == []
    assert tuples(activity.trending_repos(hourly, later, 24, 5)) == []


def test_share_of_max(hourly, spark):
    rows = activity.with_share_of_max(activity.event_breakdown(hourly, NOW, 24)).collect()
    assert [(row.event_type, row.share) for row in rows][0] == ("PushEvent", 100.0)
    assert abs(rows[1].share - 100 / 3) < 1e-9
    zero = spark.createDataFrame([("x", 0)], "event_type string, count long")
    assert activity.with_share_of_max(zero).first().share == 0.0


def test_contributors_all_time_or_since(raw):
    assert tuples(activity.top_contributors(raw, "top/repo")) == [("alice", 2), ("bob", 1)]
    assert tuples(activity.top_contributors(raw, " top/repo ", since=at(2))) == [("alice", 2)]


def test_recent_newest_first_ties_by_id(spark):
    rows = events(spark, [("1", "P", "r", "a", NOW), ("2", "P", "r", "a", NOW + timedelta(minutes=10)), ("3", "P", "r", "a", NOW)])
    frame = activity.recent_events(rows, "r")
    assert [row.id for row in frame.collect()] == ["2", "3", "1"]
    assert "payload" not in frame.columns


def test_latest_events_and_timeseries(raw):
    assert [row.id for row in activity.latest_events(raw, 3).collect()] == ["6", "4", "1"]
    rows = activity.latest_timeseries(timeseries_rows(raw), 2).collect()
    assert [row.repo_name for row in rows] == ["also/repo", "next/repo"]


def test_listing_breakdown_and_lookups(raw, hourly):
    doubled = hourly.unionByName(hourly)
    assert activity.hourly_listing(doubled, 1).first()["count"] == 2
    assert tuples(activity.repo_breakdown(hourly, "top/repo")) == [("IssuesEvent", 1), ("PushEvent", 2)]
    assert tuples(activity.repo_event_ids(raw, "top/repo")) == [("1", "PushEvent"), ("2", "PushEvent"), ("3", "IssuesEvent")]
    assert tuples(activity.event_by_id(raw, "4")) == [("4", "PushEvent", "next/repo", "carol")]


@pytest.mark.parametrize("hours,limit", [(0, 1), ("bad", 1), (169, 1), (1, 0), (1, 101)])
def test_bounds(hourly, hours, limit):
    with pytest.raises(ValueError, match="invalid (hours|limit)"):
        activity.trending_repos(hourly, NOW, hours, limit)


def test_blank_repo(raw):
    for call in (activity.top_contributors, activity.recent_events):
        with pytest.raises(ValueError, match="repo is required"):
            call(raw, "  ")


def test_dashboard_follows_the_top_repo_or_the_selected_one(raw, hourly):
    shown = dashboard(raw, hourly, NOW)
    assert tuples(shown.contributors.select("actor_name", "share")) == [("alice", 100.0), ("bob", 50.0)]
    assert [row.id for row in shown.feed.collect()] == ["1", "2", "3"]
    selected = dashboard(raw, hourly, NOW, repo="old/repo")
    assert [row.id for row in selected.feed.collect()] == ["5"]
    assert shown.as_rows().columns == ["panel", "item", "count", "share"]


def test_dashboard_without_events_is_empty(raw, hourly):
    assert dashboard(raw, hourly, NOW + timedelta(days=60)).feed.count() == 0


def test_partials_add_up_in_any_split(raw):
    whole = sorted(tuples(compact_hourly(hourly_partials(raw))))
    split = hourly_partials(raw.filter("id <= '3'")).unionByName(hourly_partials(raw.filter("id > '3'")))
    assert sorted(tuples(compact_hourly(split))) == whole


def test_rollup_since_keeps_whole_hours_only(raw):
    bounded = hourly_rollup(raw, at(2)).collect()
    assert sum(row["count"] for row in bounded) == 3


def test_timeseries_is_to_the_second(spark):
    row = timeseries_rows(events(spark, [("1", "P", "r", "a", utc(2026, 5, 5, 1, 2, 3, 999999))])).first()
    assert (row.timestamp.microsecond, row.event_type, row.repo_name) == (0, "P", "r")
