"""Merging of closed batches by size class, for all five tables, and removal of what it replaced.

A stream of small batches leaves a folder per batch and table. `merge_closed`
joins neighbouring spans of batches of one size class into an archive, and
archives into larger ones, so a table of n batches is read from about
fan · log n folders and a row is written again once per class. Readers see a
span in its outermost archive as soon as that is listed; `expire` removes the
batches and archives inside it afterwards. Stopping anywhere in between
changes no read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.rollup import compact_hourly
from tidewatch.schemas import TABLE_SCHEMAS
from tidewatch.sinks.store import (
    ARCHIVE_LIST,
    ARCHIVE_SCHEMA,
    Archive,
    TableStore,
    archived_schema,
    check_stream_id,
    exists,
    list_archive,
    remove,
    write_for_reading,
)

FAN = 8


def full_class(spans: list[tuple[int, int]], fan: int = FAN) -> list[tuple[int, int]] | None:
    """The first `fan` neighbouring spans (first, end) of the lowest size class that has so many.

    A class holds spans of fan^k to fan^(k+1) − 1 batches. `spans` are sorted and apart.
    """
    size = 1
    while spans and size <= max(end - first for first, end in spans):
        run: list[tuple[int, int]] = []
        for first, end in spans:
            fits = size <= end - first < size * fan
            run = [*(run if run and run[-1][1] == first else []), (first, end)] if fits else []
            if len(run) == fan:
                return run
        size *= fan
    return None


def closed_spans(spark: SparkSession, store: TableStore, stream_id: str, last_committed: int) -> list[tuple[int, int]]:
    """A stream's archives and its single batches before the last committed one, which no restart runs again."""
    held = [(a.first_batch, a.end_batch) for a in store.known_archives(spark) if a.stream_id == stream_id]
    starts = [0, *(end for _, end in held)]
    ends = [*(first for first, _ in held), last_committed]
    single = [(batch, batch + 1) for start, end in zip(starts, ends) for batch in range(start, end)]
    return sorted([*held, *single])


def _rows(spark: SparkSession, store: TableStore, table: str, stream_id: str, spans: list[tuple[int, int]]) -> DataFrame:
    """The rows of some spans of a table, without their batch."""
    archives = {(a.first_batch, a.end_batch): a for a in store.known_archives(spark) if a.stream_id == stream_id}
    batches = {batch for stream, batch in store.stored_batches(spark, table) if stream == stream_id}
    paths, schema = [], archived_schema(table)
    for span in spans:
        if span in archives and store.archived(spark, archives[span], table):
            paths.append(f"{archives[span].root}/{table}")
        else:
            paths += [store.batch_path(table, stream_id, batch) for batch in range(*span) if batch in batches]
    parts = [spark.read.schema(schema).parquet(path) for path in paths]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _merge(spark: SparkSession, store: TableStore, stream_id: str, spans: list[tuple[int, int]], root: str) -> Archive:
    first, end = spans[0][0], spans[-1][1]
    archive = Archive(f"{root.rstrip('/')}/{check_stream_id(stream_id)}/{first}-{end}", stream_id, first, end)
    # Left over from a merge that was stopped: not listed, so nobody reads it.
    remove(spark, archive.root)
    for table in TABLE_SCHEMAS:
        rows = _rows(spark, store, table, stream_id, spans)
        if table == "events_hourly":
            rows = compact_hourly(rows)
        write_for_reading(rows, table, f"{archive.root}/{table}")
    list_archive(spark, store.root, archive)
    return archive


def merge_closed(
    spark: SparkSession, store: TableStore, stream_id: str, last_committed: int, root: str, fan: int = FAN
) -> list[Archive]:
    """Merge closed batches into archives below `root` until no size class is full; one call at a time per stream."""
    made = []
    while spans := full_class(closed_spans(spark, store, stream_id, last_committed), fan):
        made.append(_merge(spark, store, stream_id, spans, root))
    return made


def expire(spark: SparkSession, store: TableStore, stream_id: str) -> int:
    """Remove the batches and archives that lie inside a larger archive; returns how many folders were removed.

    Call it when no query planned before the merge still runs: it would miss its files.
    """
    outer = [a for a in store.known_archives(spark) if a.stream_id == stream_id]
    removed = 0
    for table in TABLE_SCHEMAS:
        held = [a for a in outer if store.archived(spark, a, table)]
        for stream, batch in store.stored_batches(spark, table):
            if stream == stream_id and any(a.first_batch <= batch < a.end_batch for a in held):
                store.clear_batch(spark, table, stream, batch)
                removed += 1
    for stream, batch in store.marked_batches(spark):
        if stream == stream_id and any(a.first_batch <= batch < a.end_batch for a in outer):
            store.unmark(spark, stream, batch)
    path = f"{store.root.rstrip('/')}/{ARCHIVE_LIST}"
    if not exists(spark, path):
        return removed
    # Each listing is a file of its own, removed last, so a stopped run is taken up again.
    listed = spark.read.schema(ARCHIVE_SCHEMA).parquet(path).where(F.col("stream_id") == stream_id)
    for row in listed.select("*", F.col("_metadata.file_path").alias("file")).collect():
        inner = Archive(row.root, row.stream_id, row.first_batch, row.end_batch)
        if inner not in outer and all(inner.root != a.root for a in outer):
            remove(spark, inner.root)
            remove(spark, row.file)
            removed += 1
    return removed
