"""The dashboard refresh: trending, breakdown, and the top repository's contributors and feed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.activity import (
    event_breakdown,
    recent_events,
    top_contributors,
    top_repo_contributors,
    top_repo_recent,
    trending_repos,
    with_share_of_max,
)


@dataclass(frozen=True)
class Dashboard:
    trending: DataFrame
    breakdown: DataFrame
    contributors: DataFrame
    feed: DataFrame

    def as_rows(self) -> DataFrame:
        """All panels as (panel, item, count, share); the feed lists event ids."""
        none = F.lit(None)
        return (
            self.trending.select(
                F.lit("trending").alias("panel"),
                F.col("repo_name").alias("item"),
                "count",
                none.cast("double").alias("share"),
            )
            .unionByName(
                self.breakdown.select(
                    F.lit("breakdown").alias("panel"), F.col("event_type").alias("item"), "count", "share"
                )
            )
            .unionByName(
                self.contributors.select(
                    F.lit("contributors").alias("panel"), F.col("actor_name").alias("item"), "count", "share"
                )
            )
            .unionByName(
                self.feed.select(
                    F.lit("feed").alias("panel"),
                    F.col("id").alias("item"),
                    none.cast("long").alias("count"),
                    none.cast("double").alias("share"),
                )
            )
        )


def dashboard(
    raw: DataFrame,
    hourly: DataFrame,
    as_of: datetime | Column,
    hours: int = 24,
    limit: int = 10,
    repo: str | None = None,
) -> Dashboard:
    """One refresh; without a selected `repo` the top trending one is shown."""
    if repo is None:
        contributors = top_repo_contributors(raw, hourly, as_of, hours, limit)
        feed = top_repo_recent(raw, hourly, as_of, hours, limit)
    else:
        contributors = top_contributors(raw, repo, limit)
        feed = recent_events(raw, repo, limit)
    return Dashboard(
        trending_repos(hourly, as_of, hours, limit),
        with_share_of_max(event_breakdown(hourly, as_of, hours)),
        with_share_of_max(contributors),
        feed,
    )
