"""Metric samples of the storage job, and source lag from query progress."""

from __future__ import annotations

import ast
import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidewatch.operators.metrics import bound_label
from tidewatch.schemas import DEFAULT_BUCKETS

SAMPLE_SCHEMA = "ts TIMESTAMP, metric STRING, labels MAP<STRING, STRING>, value DOUBLE"


class JobMetrics:
    """Counters, gauges and latency histograms of one running job.

    They live as long as the process and start at 0 with it; the metric
    queries take the drop as a restart. One batch adds a fixed few numbers.
    """

    def __init__(self) -> None:
        self.counters: dict[tuple[str, str], float] = {}
        self.gauges: dict[str, float] = {}

    def add(self, metric: str, amount: float = 1, label: str = "") -> None:
        key = (metric, label)
        self.counters[key] = self.counters.get(key, 0.0) + amount

    def set(self, metric: str, value: float) -> None:
        self.gauges[metric] = float(value)

    def observe(self, metric: str, seconds: float) -> None:
        for bound in DEFAULT_BUCKETS:
            self.add(f"{metric}_bucket", float(seconds <= bound), bound_label(bound))
        self.add(f"{metric}_bucket", 1, "+Inf")
        self.add(f"{metric}_sum", seconds)
        self.add(f"{metric}_count", 1)

    def samples(self, spark: SparkSession, at: datetime | None = None) -> DataFrame:
        """The current values as sample rows."""
        at = at or datetime.now(timezone.utc)
        rows = []
        for (metric, label), value in self.counters.items():
            labels = {}
            if metric.endswith("_bucket"):
                labels = {"le": label}
            elif label:
                labels = {"operation": label}
            rows.append((at, metric, labels, float(value)))
        rows += [(at, metric, {}, value) for metric, value in self.gauges.items()]
        return spark.createDataFrame(rows, SAMPLE_SCHEMA).coalesce(1)


def _offsets(text) -> dict:
    """A source's offsets; empty where they are no JSON object, as those of file sources may be.

    Progress that was read back from the session shows the object as Python prints it.
    """
    try:
        offsets = json.loads(text) if isinstance(text, str) else (text or {})
    except ValueError:
        try:
            offsets = ast.literal_eval(text)
        except (ValueError, SyntaxError):
            return {}
    return offsets if isinstance(offsets, dict) else {}


def source_lag(start_or_end: str | dict | None, latest: str | dict | None) -> int | None:
    """Messages of a Kafka source not yet read, or None for other sources."""
    end, newest = _offsets(start_or_end), _offsets(latest)
    gaps = [
        newest[topic][partition] - end.get(topic, {}).get(partition, 0)
        for topic in newest
        if isinstance(newest[topic], dict)
        for partition in newest[topic]
    ]
    return sum(gaps) if gaps else None


class ProgressListener(StreamingQueryListener):
    """Copies the progress of the query called `name` into its metrics: input rows, observed counts, late rows, duration, source lag.

    Other queries of the session are left out; once the query ends the
    listener takes itself off. `after` is called with the number of each batch
    that was copied; `newest` tells the end of a source that doesn't report it.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        metrics: JobMetrics,
        after: Callable[[int], None] | None = None,
        newest: Callable[[], dict] | None = None,
    ) -> None:
        self.newest = newest
        self.spark = spark
        self.name = name
        self.metrics = metrics
        self.after = after
        self.run_id: str | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) != self.run_id:
            return
        self.metrics.add("input_rows_total", progress.numInputRows)
        for observed in progress.observedMetrics.values():
            for metric, amount in observed.asDict().items():
                self.metrics.add(metric, amount)
        if progress.stateOperators:
            dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
            self.metrics.add("rows_dropped_by_watermark_total", dropped)
        self.metrics.observe("batch_duration_seconds", progress.batchDuration / 1000)
        lags = [source_lag(source.endOffset, self._latest(source)) for source in progress.sources]
        known = [lag for lag in lags if lag is not None]
        if known:
            self.metrics.set("consumer_lag", sum(known))
        if self.after is not None:
            self.after(progress.batchId)

    def _latest(self, source) -> str | dict | None:
        """A source's newest offsets; a source that bounds its batches reports only how far it would go next, so `newest` counts first."""
        return source.latestOffset if self.newest is None else self.newest()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.spark.streams.removeListener(self)


def watch(
    spark: SparkSession,
    name: str,
    metrics: JobMetrics,
    after: Callable[[int], None] | None = None,
    newest: Callable[[], dict] | None = None,
) -> ProgressListener:
    """Follow the query that is started next under `name`."""
    listener = ProgressListener(spark, name, metrics, after, newest)
    spark.streams.addListener(listener)
    return listener
