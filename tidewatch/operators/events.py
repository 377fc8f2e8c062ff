"""Operators on single events: filter, keep-first, insert-if-absent, publish, sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.schemas import ALLOWED_TYPES

# Offsets per group when numbering a repository's events.
SEQUENCE_SPAN = 1 << 16


def filter_allowed(events: DataFrame, allowed: Sequence[str] = ALLOWED_TYPES) -> DataFrame:
    return events.filter(F.col("type").isin(*allowed))


def keep_first(events: DataFrame, order: Sequence[Column | str], key: str = "id") -> DataFrame:
    """The first event per `key` in `order`; events with an empty key are dropped.

    Spark limits each group to its first row before the shuffle as well as
    after it, so an id with very many copies sends one row per task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return (
        events.filter(F.length(key) > 0)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def insert_if_absent(new: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """The rows of `new` whose key is not stored yet; what is stored wins."""
    return new.join(stored.select(key), key, "left_anti").select(*new.columns)


def publish_keyed(events: DataFrame) -> DataFrame:
    """Topic records: key is the repository, value the payload as received."""
    return events.select(F.col("repo_name").alias("key"), F.col("payload").alias("value"))


def feed(events: DataFrame) -> DataFrame:
    """The event columns a reader sees; the payload stays unread."""
    return events.select("id", "type", "repo_name", "actor_name", "created_at")


def per_repo_sequence(messages: DataFrame) -> DataFrame:
    """Number each repository's messages 1, 2, … in (offset, partition) order as `seq`.

    Messages are numbered inside ranges of `SEQUENCE_SPAN` offsets, then each
    range is shifted by the count of the ranges before it. No task ever holds
    more of one repository than one range.
    """
    ranged = messages.withColumn("_range", F.floor(F.col("offset") / SEQUENCE_SPAN))
    inside = Window.partitionBy("repo_name", "_range").orderBy("offset", "partition")
    before = (
        Window.partitionBy("repo_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        ranged.groupBy("repo_name", "_range")
        .agg(F.count("*").alias("_n"))
        .select("repo_name", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        ranged.withColumn("_seq", F.row_number().over(inside))
        .join(shifts, ["repo_name", "_range"])
        .withColumn("seq", F.col("_seq") + F.col("_shift"))
        .drop("_range", "_seq", "_shift")
    )
