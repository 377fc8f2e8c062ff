"""Ingest: landed raw events to topic records, each accepted id once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.contract import parse_events, rejected_messages, valid_events
from tidewatch.operators.events import filter_allowed, publish_keyed
from tidewatch.schemas import ALLOWED_TYPES


def dedupe_stream(events: DataFrame, horizon: str, salt_buckets: int = 16) -> DataFrame:
    """The first event of each id among those that arrived within `horizon`.

    The watermark follows the time of arrival, so no event is ever late,
    whatever time it carries: an event dated far ahead or very old is passed on
    like any other. State is bounded by time, not by a count of ids: it scales
    by key, where one list of the last N ids would be one task. A copy that
    comes after the horizon is passed on again; durable uniqueness is the raw
    table's.

    With `salt_buckets` > 0 copies are first thinned by (id, input task), so
    the copies of one id are spread over tasks and at most `salt_buckets` of
    them reach the second step. It costs a second state; 0 turns it off.
    """
    marked = events.filter(F.length("id") > 0).withColumn("_arrived", F.current_timestamp())
    marked = marked.withWatermark("_arrived", horizon)
    if salt_buckets:
        salted = marked.withColumn("_salt", F.spark_partition_id() % salt_buckets)
        marked = salted.dropDuplicatesWithinWatermark(["id", "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(["id"]).drop("_arrived")


def accepted_events(
    landed: DataFrame, horizon: str, allowed: Sequence[str] = ALLOWED_TYPES, salt_buckets: int = 16
) -> DataFrame:
    """Parse, keep allowed types, then dedupe: refused events never take up dedupe state."""
    events = filter_allowed(valid_events(parse_events(landed)), allowed)
    return dedupe_stream(events, horizon, salt_buckets)


def accepted_messages(landed: DataFrame, horizon: str, **options) -> DataFrame:
    """Topic records of the accepted events, counted in each batch's progress."""
    records = publish_keyed(accepted_events(landed, horizon, **options))
    return records.observe("ingest", F.count(F.lit(1)).alias("events_ingested_total"))


def refused_messages(landed: DataFrame) -> DataFrame:
    """Landed texts the contract refuses, for a dead-letter query of their own."""
    refused = rejected_messages(parse_events(landed), stage="ingest").select("value", "reason", "stage")
    return refused.observe("ingest_refused", F.count(F.lit(1)).alias("events_refused_total"))
