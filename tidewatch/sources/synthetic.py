"""Synthetic load: event number i fixes every field, so any range can be made anywhere."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.json_events import event_json
from tidewatch.functions.params import positive_int, required_name
from tidewatch.functions.timebuckets import format_rfc3339, instant
from tidewatch.schemas import ALLOWED_TYPES

# Distinct repositories, actors and hours of the generator.
REPOS, ACTORS, HOURS = 100, 250, 24


def index_range(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """Event numbers start, …, end − 1 as column `i`."""
    return spark.range(start, end, 1, partitions).withColumnRenamed("id", "i")


def _padded(number: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", number)


def _fields(n: Column, prefix: str, now: datetime | Column) -> dict[str, Column]:
    prefix = required_name("prefix", prefix)
    types = F.array(*[F.lit(name) for name in ALLOWED_TYPES])
    return {
        "id": F.concat(F.lit(f"{prefix}-"), _padded(n, 6)),
        "type": F.element_at(types, (n % len(ALLOWED_TYPES) + 1).cast("int")),
        "repo_name": F.concat(F.lit(f"{prefix}/repo-"), _padded(n % REPOS, 3)),
        "actor_name": F.concat(F.lit(f"{prefix}-actor-"), _padded(n % ACTORS, 3)),
        "created_at": instant(now) - F.make_dt_interval(hours=(n % HOURS).cast("int")),
    }


def synthetic_events(index: DataFrame, prefix: str, now: datetime | Column, i: str = "i") -> DataFrame:
    """Events with a fixed payload, for seeding the analytics tables."""
    return index.select(
        *[column.alias(name) for name, column in _fields(F.col(i), prefix, now).items()],
        F.lit('{"synthetic":true}').alias("payload"),
    )


def synthetic_messages(index: DataFrame, prefix: str, now: datetime | Column, i: str = "i") -> DataFrame:
    """Topic records (key, value) whose value is a raw event in JSON."""
    event = _fields(F.col(i), prefix, now)
    value = event_json(
        event["id"],
        event["type"],
        event["repo_name"],
        event["actor_name"],
        format_rfc3339(event["created_at"]),
        synthetic=F.lit(True),
        index=F.col(i),
    )
    return index.select(event["repo_name"].alias("key"), value.alias("value"))


def generate_messages(
    spark: SparkSession, events: int, prefix: str, now: datetime, partitions: int | None = None
) -> DataFrame:
    """`events` synthetic topic records."""
    return synthetic_messages(index_range(spark, 0, positive_int("events", events), partitions), prefix, now)


def generate_events(
    spark: SparkSession, rows: int, prefix: str, now: datetime, partitions: int | None = None
) -> DataFrame:
    """`rows` synthetic events for the analytics tables."""
    return synthetic_events(index_range(spark, 0, positive_int("rows", rows), partitions), prefix, now)
