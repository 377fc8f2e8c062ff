"""The storage job: each micro-batch to raw events, hourly partials, time series, dead letters.

A batch is parsed once into a staging folder. Then come dead letters, raw,
and analytics, in this order. Raw is read back for the analytics tables, so
both are made from exactly the rows that were newly stored. The checkpoint moves on only when all writes are done or
the batch is in the dead letters; since each write replaces the batch's own
partition, a batch that runs again leaves the same tables.

One stream writes a raw table at a time: two at once could both accept an id.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.contract import check_events, rejected_messages, valid_events
from tidewatch.operators.events import insert_if_absent, keep_first
from tidewatch.operators.rollup import hourly_partials, timeseries_rows
from tidewatch.schemas import BATCH_INTERVAL, EVENT_COLUMNS, RETRY_DELAYS
from tidewatch.session import configure
from tidewatch.sinks.id_index import run_name
from tidewatch.sinks.store import TableStore, check_stream_id
from tidewatch.streaming.monitor import JobMetrics, watch
from tidewatch.streaming.retry import RetriesExhausted, is_stop, with_retry

# A batch's ids are broadcast to the raw scan only up to this many bytes;
# above it the join shuffles.
BROADCAST_ID_BYTES = 64 << 20
# What an id costs in a broadcast table beyond its own bytes.
ID_OVERHEAD_BYTES = 64

STAGED_COLUMNS = (
    *("key", "value", "topic", "partition", "offset"),
    *("id", "type", "repo_name", "actor_name", "created_at", "reason"),
)
DEAD_LETTER_COLUMNS = ("key", "value", "topic", "partition", "offset", "reason", "stage")


@dataclass
class BatchStats:
    rows: int
    valid: int
    id_bytes: int
    min_id: str | None
    max_id: str | None
    first_day: date | None
    last_day: date | None

    @property
    def ids_fit_broadcast(self) -> bool:
        return self.id_bytes + self.valid * ID_OVERHEAD_BYTES <= BROADCAST_ID_BYTES


@dataclass(frozen=True)
class OffsetRange:
    """Offsets low … high of one partition of a topic."""

    topic: str | None
    partition: int | None
    low: int
    high: int


def halves(ranges: list[OffsetRange]) -> list[list[OffsetRange]]:
    """The ranges in two parts of about equally many offsets; empty if they are a single offset."""
    total = sum(r.high - r.low + 1 for r in ranges)
    if total < 2:
        return []
    left, right, room = [], [], total // 2
    for r in ranges:
        here = min(room, r.high - r.low + 1)
        room -= here
        if here:
            left.append(OffsetRange(r.topic, r.partition, r.low, r.low + here - 1))
        if r.low + here <= r.high:
            right.append(OffsetRange(r.topic, r.partition, r.low + here, r.high))
    return [left, right]


def inside(ranges: list[OffsetRange]) -> Column:
    """Whether a message is in one of the ranges."""
    found = F.lit(False)
    for r in ranges:
        same = F.col("topic").eqNullSafe(F.lit(r.topic)) & F.col("partition").eqNullSafe(F.lit(r.partition))
        found = found | (same & F.col("offset").between(r.low, r.high))
    return found


@dataclass
class FanOut:
    """Writes micro-batches of topic messages to a store; pass `process` to foreachBatch.

    Stored ids are looked up in the store's index of known ids (`id_index`),
    whose cost does not grow with the stored events. Without it the stored
    events themselves are scanned; then `same_day_ids` tells that copies of an
    id always carry the same day of `created_at` (an event is immutable), so
    stored days other than the batch's are not searched for its ids.

    `isolate_attempts` bounds how many parts of a batch are written on trial
    when its writes keep failing, to find the messages that make them fail; 0
    sends the whole batch to the dead letters.
    """

    store: TableStore
    stream_id: str
    same_day_ids: bool = False
    id_index: bool = True
    isolate_attempts: int = 0
    delays: Sequence[float] = RETRY_DELAYS
    sleep: Callable[[float], None] = time.sleep
    metrics: JobMetrics = field(default_factory=JobMetrics)
    # Also gets each batch's dead letters, e.g. to publish them; a failure holds the progress.
    on_dead_letters: Callable[[DataFrame, int], None] | None = None
    # Whether each batch writes its metric samples to the store.
    record_samples: bool = True

    def __post_init__(self) -> None:
        check_stream_id(self.stream_id)
        self._ids_complete = False

    def process(self, messages: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        self.store.unmark(messages.sparkSession, self.stream_id, batch_id)
        parsed = self._stage(messages)
        stats = self._stats(parsed)
        malformed = rejected_messages(parsed).select(*DEAD_LETTER_COLUMNS)
        self._dead_letter(malformed, batch_id)
        failed = stats.rows - stats.valid
        try:
            with_retry(
                lambda: self._store_batch(parsed, stats, batch_id),
                self.delays,
                self.sleep,
                lambda failure: self.metrics.add("processor_retries_total"),
            )
            self.metrics.add("events_processed_total", stats.valid)
        except RetriesExhausted as failure:
            bad = self._isolate(parsed, stats, batch_id)
            if bad is None:
                # Nothing of the batch may stay in one table and miss in another, or its replay would be refused as known.
                self._clear(messages.sparkSession, batch_id)
                bad = F.lit(True)
            exhausted = self._exhausted(parsed.filter(bad), failure)
            self._dead_letter(exhausted, batch_id, malformed)
            lost = exhausted.count()
            failed += lost
            self.metrics.add("events_processed_total", stats.valid - lost)
        self.metrics.add("events_failed_total", failed)
        self.metrics.set("dlq_depth", self.metrics.counters[("events_failed_total", "")])
        self.metrics.observe("processing_duration_seconds", time.monotonic() - started)
        if self.record_samples:
            self._write(self.metrics.samples(messages.sparkSession), "metric_samples", batch_id)
        self.store.mark_whole(messages.sparkSession, self.stream_id, batch_id)

    def _clear(self, spark: SparkSession, batch_id: int) -> None:
        for table in ("raw_events", "events_hourly", "events_timeseries"):
            self.store.clear_batch(spark, table, self.stream_id, batch_id)
        self.store.ids.remove(spark, run_name(self.stream_id, batch_id))

    def _isolate(self, parsed: DataFrame, stats: BatchStats, batch_id: int) -> Column | None:
        """Which messages make the batch's writes fail; all others are stored when this returns. None if that can't be told.

        Ranges of offsets are written on trial in the batch's own partitions,
        which every write replaces, and those that fail are halved down to
        single offsets. When even no rows at all can be written the store is
        down, and no message is at fault. Ranges that are still undecided
        after `isolate_attempts` trials count as failing.
        """
        if not self.isolate_attempts:
            return None
        valid = F.col("reason").isNull()

        def stored(some: Column) -> bool:
            try:
                self._store_batch(parsed.filter(valid & some), stats, batch_id)
            except Exception as failure:
                if is_stop(failure):
                    raise
                return False
            return True

        if not stored(F.lit(False)):
            return None
        spans = parsed.filter(valid).groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
        ranges = [OffsetRange(r.topic, r.partition, r.low, r.high) for r in spans.orderBy("topic", "partition").collect()]
        failing: list[OffsetRange] = []
        open_parts, attempts = halves(ranges), 0
        while open_parts:
            part = open_parts.pop(0)
            if attempts >= self.isolate_attempts:
                failing += part
                continue
            attempts += 1
            if not stored(inside(part)):
                smaller = halves(part)
                open_parts += smaller
                failing += [] if smaller else part
        self.metrics.add("isolation_attempts_total", attempts)
        # What failed alone is left out; the rest is written together, so copies in other parts are seen.
        bad = inside(failing)
        return bad if stored(~bad) else None

    def _stage(self, messages: DataFrame) -> DataFrame:
        """The parsed batch, written to the store's staging folder and read back.

        Every later step reads just the columns it needs from there. Nothing
        is parsed or fetched from the topic twice, no executor has to keep
        the batch, and the next batch takes the folder over.
        """
        parsed = check_events(messages).select(*STAGED_COLUMNS)
        path = self.store.staging_path(self.stream_id)
        parsed.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return messages.sparkSession.read.schema(parsed.schema).parquet(path)

    def _stats(self, parsed: DataFrame) -> BatchStats:
        valid = F.col("reason").isNull()
        row = parsed.agg(
            F.count("*").alias("rows"),
            F.count_if(valid).alias("valid"),
            F.coalesce(F.sum(F.when(valid, F.octet_length("id"))), F.lit(0)).alias("id_bytes"),
            F.min(F.when(valid, F.col("id"))).alias("min_id"),
            F.max(F.when(valid, F.col("id"))).alias("max_id"),
            F.min(F.when(valid, F.col("created_at").cast("date"))).alias("first_day"),
            F.max(F.when(valid, F.col("created_at").cast("date"))).alias("last_day"),
        ).first()
        return BatchStats(
            row.rows, row.valid, row.id_bytes, row.min_id, row.max_id, row.first_day, row.last_day
        )

    def _stored_ids(self, parsed: DataFrame, stats: BatchStats, batch_id: int) -> DataFrame:
        """Ids other batches have stored, as far as this batch can meet them.

        The batch's own partition is left out: after a failure between the
        writes it may be there already. The range bounds hold for any ids
        and reach the scan, where they skip the files of other times as long
        as ids grow with time.
        """
        if self.id_index:
            return self._known_ids(parsed, stats, batch_id)
        stored = self.store.read(parsed.sparkSession, "raw_events").filter(
            ~((F.col("stream_id") == self.stream_id) & F.col("batch_id").eqNullSafe(batch_id))
        )
        stored = stored.filter(F.col("id").between(F.lit(stats.min_id), F.lit(stats.max_id)))
        if self.same_day_ids:
            stored = stored.filter(F.col("dt").between(F.lit(stats.first_day), F.lit(stats.last_day)))
        ids = stored.select("id")
        if stats.ids_fit_broadcast:
            # The batch's ids go to the stored ids instead of shuffling those.
            # What is left is a subset of the batch's ids, so it fits as well.
            batch_ids = parsed.filter(F.col("reason").isNull()).select("id").distinct()
            ids = F.broadcast(ids.join(F.broadcast(batch_ids), "id", "left_semi").distinct())
        return ids

    def _known_ids(self, parsed: DataFrame, stats: BatchStats, batch_id: int) -> DataFrame:
        """The batch's ids that other batches have stored, looked up in the index."""
        spark = parsed.sparkSession
        if not self._ids_complete:
            self.store.complete_ids(spark)
            self._ids_complete = True
        batch_ids = parsed.filter(F.col("reason").isNull()).select("id").distinct()
        known = self.store.ids.candidates(batch_ids, skip=run_name(self.stream_id, batch_id))
        if stats.ids_fit_broadcast:
            known = F.broadcast(known.join(F.broadcast(batch_ids), "id", "left_semi").distinct())
        return known

    def _store_batch(self, parsed: DataFrame, stats: BatchStats, batch_id: int) -> None:
        spark = parsed.sparkSession
        raw_started = time.monotonic()
        events = keep_first(
            valid_events(parsed).select(*EVENT_COLUMNS, "topic", "partition", "offset"),
            ["topic", "partition", "offset"],
        ).select(*EVENT_COLUMNS)
        try:
            new = insert_if_absent(events, self._stored_ids(parsed, stats, batch_id))
            self._write(new, "raw_events", batch_id)
        finally:
            self.metrics.observe("raw_write_duration_seconds", time.monotonic() - raw_started)

        analytics_started = time.monotonic()
        stored = self.store.read_batch(spark, "raw_events", self.stream_id, batch_id)
        if self.id_index:
            self.store.ids.write(stored.select("id"), run_name(self.stream_id, batch_id))
        try:
            self._write(hourly_partials(stored), "events_hourly", batch_id)
            self._write(timeseries_rows(stored), "events_timeseries", batch_id)
        finally:
            self.metrics.observe("analytics_write_duration_seconds", time.monotonic() - analytics_started)

    def _exhausted(self, parsed: DataFrame, failure: Exception) -> DataFrame:
        """Every valid message of a batch whose writes kept failing, with the last failure's first line."""
        cause = failure.__cause__
        first_line = str(cause).strip().split("\n")[0][:200] if cause else ""
        reason = f"{failure}: {type(cause).__name__}: {first_line}" if cause else str(failure)
        return (
            parsed.filter(F.col("reason").isNull())
            .withColumns({"reason": F.lit(reason), "stage": F.lit("write")})
            .select(*DEAD_LETTER_COLUMNS)
        )

    def _dead_letter(self, refused: DataFrame, batch_id: int, before: DataFrame | None = None) -> None:
        """Store the batch's dead letters, those from `before` included, and pass on the new ones."""
        everything = refused if before is None else before.unionByName(refused)
        self._write(everything, "dead_letters", batch_id)
        if self.on_dead_letters is not None:
            self.on_dead_letters(refused, batch_id)

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        self.store.write_batch(rows, table, self.stream_id, batch_id)


def start_fan_out(
    messages: DataFrame,
    job: FanOut,
    checkpoint: str,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    newest: Callable[[], dict] | None = None,
) -> StreamingQuery:
    """Start the storage job over a stream of topic messages.

    Its input rows and source lag go to `job.metrics`, and with those to the
    store's samples of the next batch. `newest` tells the newest offsets of a
    source that doesn't report them.
    """
    job.store.ensure(configure(messages.sparkSession))
    name = f"fan-out-{job.stream_id}"
    watch(messages.sparkSession, name, job.metrics, newest=newest)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        messages.writeStream.foreachBatch(job.process)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**trigger)
        .start()
    )


def replay_dead_letters(spark: SparkSession, job: FanOut, source_stream: str, batch_id: int = 0) -> None:
    """Run the messages whose writes failed in `source_stream` through `job` once more.

    The failed batches left no rows behind, so all tables take the messages
    again, and each of them alike. `job` has a stream id of its own; running
    the same (stream id, batch id) twice only replaces its first result.
    """
    if job.stream_id == source_stream:
        raise ValueError("a replay needs a stream id of its own")
    letters = job.store.read(configure(spark), "dead_letters")
    failed = letters.where((F.col("stream_id") == source_stream) & (F.col("stage") == "write"))
    messages = failed.select("key", "value", "topic", "partition", "offset", F.lit(None).cast("timestamp").alias("timestamp"))
    job.process(messages, batch_id)
