"""Hourly counts with an event-time watermark: bounded state, late rows left out and counted."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.rollup import ROLLUP_KEYS
from tidewatch.schemas import BATCH_INTERVAL
from tidewatch.session import configure
from tidewatch.streaming.monitor import JobMetrics, watch

HOURS_SCHEMA = "hour TIMESTAMP, repo_name STRING, event_type STRING, count BIGINT, batch_id BIGINT"


def watermarked_hours(events: DataFrame, lateness: str) -> DataFrame:
    """Counts by (hour, repository, type) of the distinct ids that are at most `lateness` behind the newest event.

    A row at or below the watermark of the batches before its own is late. Late
    rows are dropped by the first step, before anything is aggregated, so the
    number in its progress is one of rows. Ids are kept as long as a copy may
    come in time, hours as long as they may change. Rows without id or time
    are left out.
    """
    given = events.filter((F.length("id") > 0) & F.col("created_at").isNotNull()).select("id", "created_at", "repo_name", "type")
    unique = given.withWatermark("created_at", lateness).dropDuplicatesWithinWatermark(["id"])
    counted = unique.groupBy(F.window("created_at", "1 hour").alias("_hour"), "repo_name", F.col("type").alias("event_type"))
    return counted.agg(F.count("*").alias("count")).select(
        F.col("_hour.start").alias("hour"), "repo_name", "event_type", "count"
    )


def start_hours(
    events: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = "1 day",
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    metrics: JobMetrics | None = None,
) -> StreamingQuery:
    """Write each batch's changed hours, with their new totals, as its own partition; `read_hours` takes the newest.

    A batch that runs again replaces its own partition only. Rows dropped by
    the watermark go to `metrics` as `rows_dropped_by_watermark_total`.
    """
    spark = configure(events.sparkSession)
    name = f"hours-{uuid.uuid4().hex[:8]}"
    watch(spark, name, metrics or JobMetrics())

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        watermarked_hours(events, lateness)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """One row per (hour, repository, type): the total of the last batch that changed it."""
    rows = spark.read.schema(HOURS_SCHEMA).parquet(path)
    return rows.groupBy(*ROLLUP_KEYS).agg(F.max_by("count", "batch_id").alias("count"))


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, by the progress the query still keeps."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
