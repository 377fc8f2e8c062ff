"""Running the streams over the driver's tables, to read back what they stored.

The topic is landed as files in the shared working folder, because a stream
needs files that arrive. One landing and one fan-out per session and data
folder serve all queries that read their tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.contract import parse_events, valid_events
from tidewatch.operators.events import publish_keyed
from tidewatch.operators.rollup import hourly_partials, timeseries_rows
from tidewatch.plans import driver_tables as dt
from tidewatch.schemas import DEFAULT_TOPIC, EVENT_COLUMNS, TOPIC_COLUMNS, TOPIC_SCHEMA
from tidewatch.session import working_folder
from tidewatch.sinks import clustering
from tidewatch.sinks.digests import differing_ids, write_tree
from tidewatch.sinks.publish import publish, start_publishing
from tidewatch.sinks.store import TableStore, read_written, write_for_reading
from tidewatch.sinks.tiers import expire, merge_closed
from tidewatch.sources.snapshot import stream_lines
from tidewatch.sources.topic import stream_topic_files, stream_topic_log
from tidewatch.sources.topic_log import FORMAT, newest_offsets, register
from tidewatch.streaming.fanout import FanOut, start_fan_out
from tidewatch.streaming.hours import late_rows, read_hours, start_hours
from tidewatch.streaming.ingest import accepted_messages, dedupe_stream
from tidewatch.streaming.last_ids import dedupe_last
from tidewatch.streaming.series import stream_increases, sum_increases

# How long after its arrival an id is remembered at ingest; both deliveries of a run lie within it.
HORIZON = "2 hours"

# Files per micro-batch, so that a catch-up over a very large topic runs in parts.
MAX_FILES = 2000

# Ids a shard of the dedupe by number remembers.
SHARD_IDS = 100_000

_stores: dict[tuple[str, str], TableStore] = {}
_written: dict[tuple[str, str, str], str] = {}


def _land(spark: SparkSession, sf_dir: str, path: str) -> None:
    publish(dt.topic(spark, sf_dir).select(*TOPIC_COLUMNS), path=path)


def stored(spark: SparkSession, sf_dir: str) -> TableStore:
    """The tables after the topic was delivered, and then delivered again to the restarted job."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        folder = working_folder(spark, "fan-out")
        store = TableStore(f"{folder}/tables")
        for _ in range(2):
            _land(spark, sf_dir, f"{folder}/topic")
            messages = stream_topic_files(spark, f"{folder}/topic", MAX_FILES)
            job = FanOut(store, "events", isolate_attempts=64)
            start_fan_out(messages, job, f"{folder}/checkpoint", available_now=True).awaitTermination()
        _stores[key] = store
    return _stores[key]


def _for_reading(spark: SparkSession, sf_dir: str, name: str, raw: DataFrame) -> str:
    """The folder of the three day tables of `raw`, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        folder = working_folder(spark, name)
        raw = raw.select(*EVENT_COLUMNS)
        write_for_reading(raw, "raw_events", f"{folder}/raw_events")
        raw = read_written(spark, "raw_events", f"{folder}/raw_events")
        write_for_reading(hourly_partials(raw), "events_hourly", f"{folder}/events_hourly")
        write_for_reading(timeseries_rows(raw), "events_timeseries", f"{folder}/events_timeseries")
        _written[key] = folder
    return _written[key]


def written(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A day table of all events, in the layout that reads are made for."""
    folder = _for_reading(spark, sf_dir, "reading", dt.raw(spark, sf_dir))
    return read_written(spark, table, f"{folder}/{table}")


def clustered(spark: SparkSession, sf_dir: str) -> str:
    """The folder of all events clustered by repository and time, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, "clustered")
    if key not in _written:
        folder = working_folder(spark, "clustered")
        raw = dt.raw(spark, sf_dir)
        # Some files a day also of a small table, and of a large one no more than it needs.
        clustering.write_clustered(raw, folder, file_rows=max(1, min(clustering.FILE_ROWS, raw.count() // 240)))
        _written[key] = folder
    return _written[key]


def tiered(spark: SparkSession, sf_dir: str) -> TableStore:
    """The tables of five batches, a fifth of the time each, whose closed ones were merged by size class, two at a time, and removed."""
    folder = working_folder(spark, "tiers")
    store, raw = TableStore(f"{folder}/tables"), dt.raw(spark, sf_dir).select(*EVENT_COLUMNS)
    store.ensure(spark)
    ends = raw.agg(F.unix_micros(F.min("created_at")).alias("a"), F.unix_micros(F.max("created_at")).alias("b")).first()
    span = (ends.b or 0) - (ends.a or 0) + 1
    for batch in range(5):
        rows = raw.where(F.floor((F.unix_micros("created_at") - (ends.a or 0)) * 5 / span) == batch)
        store.write_batch(rows, "raw_events", "events", batch)
        rows = store.read_batch(spark, "raw_events", "events", batch)
        store.write_batch(hourly_partials(rows), "events_hourly", "events", batch)
        store.write_batch(timeseries_rows(rows), "events_timeseries", "events", batch)
    merge_closed(spark, store, "events", 4, f"{folder}/merged", fan=2)
    expire(spark, store, "events")
    return store


def written_runs(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """As `written`, each event belonging to the run of its type: ids start with `type-`, repositories with `type/`."""
    runs = dt.raw(spark, sf_dir).withColumns(
        {
            "id": F.concat("type", F.lit("-"), "id"),
            "repo_name": F.concat("type", F.lit("/"), "repo_name"),
        }
    )
    folder = _for_reading(spark, sf_dir, "runs", runs)
    return read_written(spark, table, f"{folder}/{table}")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of a twice delivered topic after streaming dedupe."""
    folder = working_folder(spark, "dedupe")
    for _ in range(2):
        _land(spark, sf_dir, f"{folder}/topic")
    events = valid_events(parse_events(stream_topic_files(spark, f"{folder}/topic", MAX_FILES)))
    (
        dedupe_stream(events, HORIZON)
        .select("id", "type")
        .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .format("parquet")
        .option("path", f"{folder}/unique")
        .start()
        .awaitTermination()
    )
    return spark.read.schema("id STRING, type STRING").parquet(f"{folder}/unique")


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records published from raw events landed one per line."""
    folder = working_folder(spark, "ingest")
    dt.topic(spark, sf_dir).select("value").write.text(f"{folder}/landed")
    messages = accepted_messages(
        stream_lines(spark, f"{folder}/landed", MAX_FILES), HORIZON, allowed=dt.TABLE_ALLOWED_TYPES
    )
    start_publishing(
        messages, f"{folder}/checkpoint", path=f"{folder}/published", available_now=True
    ).awaitTermination()
    return spark.read.schema("key STRING, value STRING").parquet(f"{folder}/published")


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a rate-limited stream, and whether every micro-batch kept to its one file."""
    folder = working_folder(spark, "batches")
    for _ in range(2):
        _land(spark, sf_dir, f"{folder}/topic")

    def count_batch(messages: DataFrame, batch_id: int) -> None:
        counted = messages.withColumn("file", F.input_file_name()).agg(
            F.count("*").alias("messages"), F.count_distinct("file").alias("files")
        )
        counted.write.mode("overwrite").parquet(f"{folder}/counts/batch_id={batch_id}")

    (
        stream_topic_files(spark, f"{folder}/topic", max_files=1)
        .writeStream.foreachBatch(count_batch)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return (
        spark.read.schema("messages BIGINT, files BIGINT, batch_id BIGINT")
        .parquet(f"{folder}/counts")
        .agg(
            F.sum("messages").alias("messages"),
            (F.max("files") == 1).alias("one_file_per_batch"),
        )
    )


def _log(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a topic log that holds the valid messages, published once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, "log")
    if key not in _written:
        _written[key] = working_folder(spark, "topic-log")
        publish(publish_keyed(valid_events(parse_events(dt.topic(spark, sf_dir)))), log=_written[key])
    return _written[key]


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a topic log with the count of their key, and whether its key and offsets are as they should be."""
    messages = register(spark).read.format(FORMAT).option("path", _log(spark, sf_dir)).load()
    ends = messages.groupBy("partition").agg((F.max("offset") + 1 == F.count_distinct("offset")).alias("whole"))
    keys = messages.groupBy("key").agg(F.count("*").alias("of_key"), (F.min("partition") == F.max("partition")).alias("alone"))
    rows = messages.join(keys, "key").join(ends, "partition")
    return rows.select("key", "value", "of_key", (F.col("alone") & F.col("whole")).alias("one_partition"))


def log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and distinct offsets of a stream over the topic log, and whether every micro-batch kept to its bound."""
    folder, path = working_folder(spark, "log-batches"), _log(spark, sf_dir)
    total = sum(newest_offsets(path)[DEFAULT_TOPIC].values())
    most = max(1, -(-total // 4))
    query = (
        stream_topic_log(spark, path, max_offsets=most)
        .writeStream.foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch}"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="0 seconds")
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(f"{TOPIC_SCHEMA}, batch_id BIGINT").parquet(f"{folder}/rows")
    sizes = rows.groupBy("batch_id").count().agg((F.max("count") <= most).alias("bounded"))
    counted = rows.agg(F.count("*").alias("messages"), F.count_distinct("partition", "offset").alias("offsets"))
    return counted.join(F.broadcast(sizes))


def watermarked(spark: SparkSession, sf_dir: str, lateness: str) -> DataFrame:
    """Hourly counts of a twice delivered topic, each delivery one batch, and the rows the watermark dropped in all."""
    folder, late = working_folder(spark, "hours"), 0
    for _ in range(2):
        _land(spark, sf_dir, f"{folder}/topic")
        events = valid_events(parse_events(stream_topic_files(spark, f"{folder}/topic")))
        query = start_hours(events, f"{folder}/hours", f"{folder}/checkpoint", lateness, available_now=True)
        query.awaitTermination()
        late += late_rows(query)
    return read_hours(spark, f"{folder}/hours").withColumn("late", F.lit(late).cast("long"))


def remembered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of a twice delivered topic after the dedupe bounded by a number of ids.

    There are enough shards for each to hold about half its limit, so no copy comes too late.
    """
    folder = working_folder(spark, "last-ids")
    shards = max(8, -(-2 * dt.topic(spark, sf_dir).count() // SHARD_IDS))
    for _ in range(2):
        _land(spark, sf_dir, f"{folder}/topic")
        events = valid_events(parse_events(stream_topic_files(spark, f"{folder}/topic"))).select("id", "type", "created_at")
        (
            dedupe_last(events, SHARD_IDS, ["created_at", "id"], shards)
            .select("id", "type")
            .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .option("path", f"{folder}/unique")
            .start()
            .awaitTermination()
        )
    return spark.read.schema("id STRING, type STRING").parquet(f"{folder}/unique")


def increased(spark: SparkSession, sf_dir: str, window_seconds: int) -> DataFrame:
    """Increases per series and window of samples that arrive in two parts, the second after the job was started again."""
    folder = working_folder(spark, "increases")
    samples = dt.processed_samples(spark, sf_dir)
    samples.write.parquet(f"{folder}/all")
    whole = spark.read.schema(samples.schema).parquet(f"{folder}/all")
    ends = whole.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts")).alias("b")).first()
    middle = F.timestamp_micros(F.lit(((ends.a or 0) + (ends.b or 0)) // 2))
    for part in (F.col("ts") <= middle, F.col("ts") > middle):
        whole.where(part).write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(samples.schema).parquet(f"{folder}/in")
        (
            # Every series lives as long as the table does.
            stream_increases(arriving, window_seconds, expiry_seconds=10 * 365 * 86400)
            .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .format("parquet")
            .option("path", f"{folder}/out")
            .start()
            .awaitTermination()
        )
    schema = "metric STRING, labels MAP<STRING, STRING>, window_start TIMESTAMP, increase DOUBLE"
    return sum_increases(spark.read.schema(schema).parquet(f"{folder}/out"))


def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in which the event table and the topic's valid events differ, by their hash trees."""
    folder, columns = working_folder(spark, "trees"), ["id", "type", "repo_name", "actor_name", "created_at"]
    write_tree(dt.raw(spark, sf_dir), f"{folder}/table", columns=columns)
    write_tree(valid_events(parse_events(dt.topic(spark, sf_dir))), f"{folder}/topic", columns=columns)
    return differing_ids(spark, f"{folder}/table", f"{folder}/topic")
