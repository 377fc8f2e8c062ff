"""Hourly partial counts, their sums, and the narrow time series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.timebuckets import hour_bucket, instant, second_bucket

ROLLUP_KEYS = ("hour", "repo_name", "event_type")


def hourly_partials(events: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts by (hour, repository, type) of one set of events, plus `extra_keys`.

    The result is partial: readers sum it, so parts of any size and order add up.
    """
    return events.groupBy(
        *extra_keys,
        hour_bucket(F.col("created_at")).alias("hour"),
        "repo_name",
        F.col("type").alias("event_type"),
    ).agg(F.sum(F.lit(1).cast("long")).alias("count"))


def hourly_rollup(events: DataFrame, since: datetime | Column | None = None) -> DataFrame:
    """Hourly counts, optionally only of hours that start at or after `since`.

    An hour at or after `since` holds only events at or after it, so the bound
    is also put on `created_at`, where it prunes the scan.
    """
    if since is None:
        return hourly_partials(events)
    bound = instant(since)
    return hourly_partials(events.filter(F.col("created_at") >= bound)).filter(
        F.col("hour") >= bound
    )


def compact_hourly(partials: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per (hour, repository, type): equal keys summed."""
    return partials.groupBy(*extra_keys, *ROLLUP_KEYS).agg(F.sum("count").alias("count"))


def timeseries_rows(events: DataFrame) -> DataFrame:
    """One narrow row per event, to the second, without the payload."""
    return events.select(
        second_bucket(F.col("created_at")).alias("timestamp"),
        F.col("type").alias("event_type"),
        "repo_name",
    )
