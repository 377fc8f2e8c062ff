"""The read queries: trending, breakdown, contributors, feeds, listings, drill-downs.

`hourly` is the rollup (hour, repo_name, event_type, count) and may hold
several partial rows per key; `raw` is the event table; `as_of` is the end of
the time window, a datetime or a column such as a scalar subquery.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.params import bounded_int, required_name
from tidewatch.functions.timebuckets import cutoff, instant
from tidewatch.operators.events import feed
from tidewatch.schemas import (
    DEFAULT_BREAKDOWN_HOURS,
    DEFAULT_CONTRIBUTORS_LIMIT,
    DEFAULT_LISTING_LIMIT,
    DEFAULT_RECENT_LIMIT,
    DEFAULT_TRENDING_HOURS,
    DEFAULT_TRENDING_LIMIT,
    MAX_HOURS,
    MAX_LIMIT,
)


def since_hour(hourly: DataFrame, start: Column) -> DataFrame:
    """Hours at or after `start`; a `dt` partition column is pruned with it."""
    kept = hourly.filter(F.col("hour") >= start)
    if "dt" in hourly.columns:
        kept = kept.filter(F.col("dt") >= start.cast("date"))
    return kept


def trending_repos(hourly: DataFrame, as_of: datetime | Column, hours=None, limit=None) -> DataFrame:
    """Repositories with most events in the last `hours`."""
    hours = bounded_int("hours", hours, DEFAULT_TRENDING_HOURS, 1, MAX_HOURS)
    limit = bounded_int("limit", limit, DEFAULT_TRENDING_LIMIT, 1, MAX_LIMIT)
    return (
        since_hour(hourly, cutoff(as_of, hours))
        .groupBy("repo_name")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "repo_name")
        .limit(limit)
    )


def event_breakdown(hourly: DataFrame, as_of: datetime | Column, hours=None) -> DataFrame:
    """Events per type in the last `hours`."""
    hours = bounded_int("hours", hours, DEFAULT_BREAKDOWN_HOURS, 1, MAX_HOURS)
    return (
        since_hour(hourly, cutoff(as_of, hours))
        .groupBy("event_type")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def _rank_contributors(events: DataFrame, limit: int) -> DataFrame:
    return (
        events.groupBy("actor_name")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "actor_name")
        .limit(limit)
    )


def top_contributors(
    raw: DataFrame, repo: str, limit=None, since: datetime | Column | None = None
) -> DataFrame:
    """Most active actors of a repository, over all time unless `since` is given."""
    repo = required_name("repo", repo)
    limit = bounded_int("limit", limit, DEFAULT_CONTRIBUTORS_LIMIT, 1, MAX_LIMIT)
    events = raw.filter(F.col("repo_name") == repo)
    if since is not None:
        events = events.filter(F.col("created_at") >= instant(since))
    return _rank_contributors(events, limit)


def _newest(events: DataFrame, limit: int) -> DataFrame:
    return feed(events).orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def recent_events(raw: DataFrame, repo: str, limit=None) -> DataFrame:
    """Newest events of a repository."""
    repo = required_name("repo", repo)
    limit = bounded_int("limit", limit, DEFAULT_RECENT_LIMIT, 1, MAX_LIMIT)
    return _newest(raw.filter(F.col("repo_name") == repo), limit)


def newest_days(rows: DataFrame, at: str, amount: Column, least: int) -> DataFrame:
    """The newest days of a table partitioned by `dt` that hold at least `least` by `amount`; other tables whole.

    A day's `amount` is counted from as few columns as it needs, none for a
    row count. The first day that is kept is one value, compared with `at`, so
    it reaches the scan and the files of earlier days are skipped.
    """
    if "dt" not in rows.columns:
        return rows
    # A row per day of the table.
    newer = Window.orderBy(F.desc("dt")).rowsBetween(Window.unboundedPreceding, -1)
    by_day = rows.groupBy("dt").agg(amount.alias("n")).withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    first = by_day.filter(F.col("newer") < least).agg(F.min("dt").cast("timestamp")).scalar()
    return rows.filter(F.col(at) >= first)


def latest_events(raw: DataFrame, limit=None) -> DataFrame:
    """Newest events of all repositories."""
    limit = bounded_int("limit", limit, DEFAULT_LISTING_LIMIT, 1, MAX_LIMIT)
    return _newest(newest_days(raw, "created_at", F.count("*"), limit), limit)


def latest_timeseries(timeseries: DataFrame, limit=None) -> DataFrame:
    limit = bounded_int("limit", limit, DEFAULT_LISTING_LIMIT, 1, MAX_LIMIT)
    return (
        newest_days(timeseries, "timestamp", F.count("*"), limit)
        .select("timestamp", "repo_name", "event_type")
        .orderBy(F.desc("timestamp"), "repo_name", "event_type")
        .limit(limit)
    )


def hourly_listing(hourly: DataFrame, limit=None) -> DataFrame:
    """Newest hours of the rollup, summed by all three keys; every hour holds at least one."""
    limit = bounded_int("limit", limit, DEFAULT_LISTING_LIMIT, 1, MAX_LIMIT)
    return (
        newest_days(hourly, "hour", F.count_distinct("hour"), limit)
        .groupBy("hour", "repo_name", "event_type")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("hour"), "repo_name", "event_type")
        .limit(limit)
    )


def repo_breakdown(hourly: DataFrame, repo: str) -> DataFrame:
    """Events per type of one repository, over all time."""
    repo = required_name("repo", repo)
    return (
        hourly.filter(F.col("repo_name") == repo)
        .groupBy("event_type")
        .agg(F.sum("count").alias("count"))
        .orderBy("event_type")
    )


def repo_event_ids(raw: DataFrame, repo: str) -> DataFrame:
    """Ids and types of a repository's events, by id."""
    repo = required_name("repo", repo)
    return raw.filter(F.col("repo_name") == repo).select("id", "type").orderBy("id")


def event_by_id(raw: DataFrame, event_id: str) -> DataFrame:
    return raw.filter(F.col("id") == required_name("id", event_id)).select(
        "id", "type", "repo_name", "actor_name"
    )


def event_trend(timeseries: DataFrame) -> DataFrame:
    """Events per hour and type, from the time series."""
    return (
        timeseries.groupBy(F.window("timestamp", "1 hour").alias("w"), "event_type")
        .agg(F.count("*").alias("count"))
        .select(F.col("w.start").alias("hour"), "event_type", "count")
    )


def with_share_of_max(ranked: DataFrame) -> DataFrame:
    """Add `share`: each count in percent of the largest (at least 1).

    The maximum is a scalar subquery, so no row set is gathered in one task.
    """
    largest = ranked.agg(F.max("count").alias("m")).scalar()
    return ranked.withColumn(
        "share", F.col("count") * 100.0 / F.greatest(largest, F.lit(1).cast("long"))
    )


def top_repo(hourly: DataFrame, as_of: datetime | Column, hours=DEFAULT_BREAKDOWN_HOURS) -> Column:
    """The name of the top trending repository, as a scalar subquery."""
    return trending_repos(hourly, as_of, hours, 1).select("repo_name").scalar()


def top_repo_contributors(
    raw: DataFrame, hourly: DataFrame, as_of: datetime | Column, hours=DEFAULT_BREAKDOWN_HOURS, limit=None
) -> DataFrame:
    """Contributors of the top trending repository.

    The name is one value, found first and then pushed into the scan of `raw`
    like a literal, so files without the repository are skipped.
    """
    limit = bounded_int("limit", limit, DEFAULT_CONTRIBUTORS_LIMIT, 1, MAX_LIMIT)
    return _rank_contributors(raw.filter(F.col("repo_name") == top_repo(hourly, as_of, hours)), limit)


def top_repo_recent(
    raw: DataFrame, hourly: DataFrame, as_of: datetime | Column, hours=DEFAULT_BREAKDOWN_HOURS, limit=10
) -> DataFrame:
    """Newest events of the top trending repository."""
    limit = bounded_int("limit", limit, 10, 1, MAX_LIMIT)
    return _newest(raw.filter(F.col("repo_name") == top_repo(hourly, as_of, hours)), limit)
