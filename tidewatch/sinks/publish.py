"""Writing keyed records to the topic: Kafka, or files with the same columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewatch.schemas import POLL_INTERVAL
from tidewatch.session import configure
from tidewatch.sinks.store import TableStore, check_stream_id
from tidewatch.sources.topic_log import FORMAT, register
from tidewatch.streaming.monitor import JobMetrics, watch


def _one_target(kafka: dict[str, str] | None, path: str | None, log: str | None = None) -> None:
    if sum(target is not None for target in (kafka, path, log)) != 1:
        raise ValueError("give kafka options or a path")


def publish(records: DataFrame, kafka: dict[str, str] | None = None, path: str | None = None, log: str | None = None) -> None:
    """Append a batch of (key, value) records; Kafka and the topic log spread them over partitions by key hash."""
    _one_target(kafka, path, log)
    if log is not None:
        register(records.sparkSession)
        records.select("key", "value").write.format(FORMAT).mode("append").option("path", log).save()
    elif kafka is not None:
        records.select("key", "value").write.format("kafka").options(**kafka).save()
    else:
        records.write.mode("append").parquet(path)


def start_publishing(
    records: DataFrame,
    checkpoint: str,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    available_now: bool = False,
    interval: str = POLL_INTERVAL,
    metrics: JobMetrics | None = None,
    store: TableStore | None = None,
    stream_id: str = "ingest",
    log: str | None = None,
) -> StreamingQuery:
    """Publish a stream of (key, value) records to Kafka, to files, or to the topic log in a folder.

    In the topic log an epoch that runs again adds nothing, under the same `stream_id`.

    Its input rows, observed counts and source lag go to `metrics`, and with a
    `store` each batch's samples are written there under `stream_id`.
    """
    _one_target(kafka, path, log)
    check_stream_id(stream_id)
    spark = configure(records.sparkSession)
    metrics = metrics or JobMetrics()
    after = None
    if store is not None:
        store.ensure(spark)

        def after(batch_id: int) -> None:
            store.write_batch(metrics.samples(spark), "metric_samples", stream_id, batch_id)

    name = f"publish-{stream_id}-{uuid.uuid4().hex[:8]}"
    watch(spark, name, metrics, after)
    writer = records.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    writer = writer.trigger(**trigger)
    if log is not None:
        register(spark)
        return writer.format(FORMAT).option("path", log).option("writer", stream_id).start()
    if kafka is not None:
        return writer.format("kafka").options(**kafka).start()
    return writer.format("parquet").option("path", path).start()
