"""The driver's `events` table seen through the engine's data model.

Every function reads the whole table. Two views of it are used: the stored
tables (raw, rollup, time series), which map each row directly, and the
topic, whose messages carry the same events as JSON with a fixed pattern of
defects, so that the contract has something to refuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.json_events import event_json
from tidewatch.functions.timebuckets import cutoff
from tidewatch.operators.metrics import histogram
from tidewatch.operators.rollup import hourly_partials, hourly_rollup, timeseries_rows
from tidewatch.schemas import EVENT_COLUMNS

# The types kept at ingest in this data; `error` events are refused.
TABLE_ALLOWED_TYPES = ("click", "purchase", "signup", "view")

PARTITIONS = 3


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The newest event time, found by the query itself."""
    return events(spark, sf_dir).agg(F.max("ts")).scalar()


def _mapped(rows: DataFrame) -> DataFrame:
    repo = F.concat(F.lit("org/repo-"), F.lpad(F.get_json_object("props", "$.k"), 3, "0"))
    return rows.select(
        "event_id",
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        repo.alias("repo_name"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("actor_name"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("value").alias("amount"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / PARTITIONS).alias("offset"),
    )


def _text(created_at: Column | None = None, repo: Column | None = None) -> Column:
    written = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return event_json(
        F.col("id"),
        F.col("type"),
        F.col("repo_name") if repo is None else repo,
        F.col("actor_name"),
        written if created_at is None else created_at,
    )


def raw(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    """The raw event table; `since` bounds the scan itself."""
    rows = events(spark, sf_dir)
    if since is not None:
        rows = rows.filter(F.col("ts") >= since)
    return _mapped(rows).withColumn("payload", _text()).select(*EVENT_COLUMNS, "partition", "offset")


def window(spark: SparkSession, sf_dir: str, hours: int) -> tuple[Column, Column]:
    """Start and end of the last `hours` of the table.

    Both come from one subquery whose value is the start itself: compared
    with `ts` it reaches the parquet scan, which an expression over a
    subquery, or two subqueries merged into one, would not.
    """
    start = events(spark, sf_dir).agg(cutoff(F.max("ts"), hours)).scalar()
    return start, (start + F.make_dt_interval(hours=F.lit(hours))).cast("timestamp")


def hourly(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    """The rollup, all of it or the hours that start at or after `since`."""
    if since is None:
        return hourly_partials(raw(spark, sf_dir))
    return hourly_rollup(raw(spark, sf_dir, since), since.cast("timestamp"))


def timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries_rows(raw(spark, sf_dir))


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a topic message. A fixed share is damaged: cut off, without a repository, or mistimed."""
    number = F.col("event_id")
    value = (
        F.when(number % 97 == 0, F.left(_text(), F.lit(20)))
        .when(number % 89 == 0, _text(repo=F.lit(None).cast("string")))
        .when(number % 83 == 0, _text(created_at=F.lit("not-a-time")))
        .otherwise(_text())
    )
    return _mapped(events(spark, sf_dir)).select(
        F.col("repo_name").alias("key"),
        value.alias("value"),
        F.lit("activity").alias("topic"),
        "partition",
        "offset",
        F.col("created_at").alias("timestamp"),
    )


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic with every message delivered twice, `delivery` 0 and 1."""
    once = topic(spark, sf_dir)
    return once.withColumn("delivery", F.lit(0)).unionByName(once.withColumn("delivery", F.lit(1)))


def is_done(spark: SparkSession, sf_dir: str) -> Column:
    """Whether a message is done; errors of the last day are still being retried."""
    newest = as_of(spark, sf_dir).cast("timestamp")
    retried = F.col("value").contains('"type":"error"') & (F.col("timestamp") >= cutoff(newest, 24))
    return ~retried


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as an access log: path and status by type, duration by value."""
    return events(spark, sf_dir).select(
        F.lit("GET").alias("method"),
        F.concat(F.lit("/"), F.col("event_type")).alias("path"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (F.col("value") / F.lit(100.0)).alias("duration"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def _restarting(counts: DataFrame, series: list[str]) -> DataFrame:
    """Running totals of `n` by `ts` that start again every week, as a process restart does."""
    week = F.date_trunc("week", F.col("ts"))
    running = (
        Window.partitionBy(*series, week).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    )
    return counts.withColumn("value", F.sum("n").over(running).cast("double"))


def processed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter `events_processed_total` per type, sampled each minute with events."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("ts")
    counts = events(spark, sf_dir).groupBy("event_type", minute).agg(F.count("*").alias("n"))
    return _restarting(counts, ["event_type"]).select(
        "ts",
        F.lit("events_processed_total").alias("metric"),
        F.create_map(F.lit("operation"), F.col("event_type")).alias("labels"),
        "value",
    )


def request_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter `api_requests_total` by method, path and status, sampled hourly."""
    hour = F.date_trunc("hour", F.col("created_at")).alias("ts")
    labels = ["method", "path", "status"]
    counts = requests(spark, sf_dir).groupBy(*labels, hour).agg(F.count("*").alias("n"))
    return _restarting(counts, labels).select(
        "ts",
        F.lit("api_requests_total").alias("metric"),
        F.create_map(*[part for name in labels for part in (F.lit(name), F.col(name))]).alias("labels"),
        "value",
    )


def lag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge `consumer_lag` per type: the events of each hour."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")
    counts = events(spark, sf_dir).groupBy("event_type", hour).agg(F.count("*").alias("n"))
    return counts.select(
        "ts",
        F.lit("consumer_lag").alias("metric"),
        F.create_map(F.lit("operation"), F.col("event_type")).alias("labels"),
        F.col("n").cast("double").alias("value"),
    )


def duration_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket counters of `api_request_duration_seconds` per type, sampled hourly."""
    hourly_requests = requests(spark, sf_dir).withColumn("ts", F.date_trunc("hour", F.col("created_at")))
    buckets = histogram(hourly_requests, "duration", ["path", "ts"]).withColumnRenamed("count", "n")
    return _restarting(buckets, ["path", "le"]).select(
        "ts",
        F.lit("api_request_duration_seconds_bucket").alias("metric"),
        F.create_map(F.lit("path"), F.col("path"), F.lit("le"), F.col("le")).alias("labels"),
        "value",
    )


def without_zones(rows: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, the type the comparison tables use."""
    return rows.select(
        *[
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in rows.schema.fields
        ]
    )
