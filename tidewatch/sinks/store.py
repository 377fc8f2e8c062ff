"""Tables written by streams, in one shared folder.

Every table is partitioned by (stream_id, batch_id) and a batch only ever
replaces its own partition, so a batch that is run again after a failure
leaves the same rows as a batch that ran once. `stream_id` must be new for
every new checkpoint, because batch numbers start again at 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.rollup import compact_hourly
from tidewatch.schemas import BATCH_COLUMNS, TABLE_SCHEMAS, TABLE_SORT
from tidewatch.sinks.id_index import IdIndex, covered, run_name

_STREAM_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")

# The column whose date is a table's `dt` partition.
DAY_SOURCE = {
    "raw_events": "created_at",
    "events_hourly": "hour",
    "events_timeseries": "timestamp",
}


def archived_schema(table: str) -> str:
    """A table's columns without the batch partition."""
    columns = TABLE_SCHEMAS[table].rsplit(f", {BATCH_COLUMNS}", 1)[0]
    return f"{columns}, dt DATE" if table in DAY_SOURCE else columns


def check_stream_id(stream_id: str) -> str:
    if not _STREAM_ID.fullmatch(stream_id):
        raise ValueError("invalid stream_id")
    return stream_id


@dataclass(frozen=True)
class Archive:
    """Batches first_batch … end_batch − 1 of a stream, rewritten for reading below `root`."""

    root: str
    stream_id: str
    first_batch: int
    end_batch: int

    def holds(self) -> Column:
        """Whether a row of a live table is in this archive."""
        return (F.col("stream_id") == self.stream_id) & F.col("batch_id").between(
            self.first_batch, self.end_batch - 1
        )

    def replaces(self, other: Archive) -> bool:
        """Whether this archive holds all of another one's batches and more."""
        inside = self.first_batch <= other.first_batch and other.end_batch <= self.end_batch
        size, others = self.end_batch - self.first_batch, other.end_batch - other.first_batch
        return self.stream_id == other.stream_id and inside and size > others


ARCHIVE_LIST = "archives"
MARKS = "whole_batches"
ARCHIVE_SCHEMA = "root STRING, stream_id STRING, first_batch BIGINT, end_batch BIGINT"


@dataclass(frozen=True)
class TableStore:
    """The five tables below `root`, a folder every executor can reach.

    Small batches leave many small files. `archives` name closed batches that
    were rewritten in large ones: reads take those rows from the archive and
    leave out the batches themselves, which may then be removed. Archives made
    by `archive_batches` are listed in the root, so every store on it reads
    them; `archives` may name further ones.
    """

    root: str
    archives: tuple[Archive, ...] = ()

    def path(self, table: str) -> str:
        if table not in TABLE_SCHEMAS:
            raise ValueError(f"unknown table {table}")
        return f"{self.root.rstrip('/')}/{table}"

    def batch_path(self, table: str, stream_id: str, batch_id: int) -> str:
        return f"{self.path(table)}/stream_id={check_stream_id(stream_id)}/batch_id={batch_id}"

    def staging_path(self, stream_id: str) -> str:
        return f"{self.root.rstrip('/')}/staging/stream_id={check_stream_id(stream_id)}"

    def ensure(self, spark: SparkSession) -> None:
        """Create the tables that do not exist yet."""
        for table, schema in TABLE_SCHEMAS.items():
            empty = spark.createDataFrame([], schema)
            days = ["dt"] if table in DAY_SOURCE else []
            empty.write.mode("ignore").partitionBy("stream_id", "batch_id", *days).parquet(self.path(table))

    def ensure_catalog(self, spark: SparkSession, database: str) -> None:
        """Register the tables in a catalog database, so SQL can name them, with the batches written so far."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for table, schema in TABLE_SCHEMAS.items():
            days = ", dt" if table in DAY_SOURCE else ""
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{database}`.{table} ({schema}) USING parquet "
                f"PARTITIONED BY (stream_id, batch_id{days}) LOCATION '{self.path(table)}'"
            )
        self.refresh_catalog(spark, database)

    def refresh_catalog(self, spark: SparkSession, database: str) -> None:
        """Let the catalog find the batches written since; one listing of every table."""
        for table in TABLE_SCHEMAS:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.{table}")

    def add_to_catalog(self, spark: SparkSession, database: str, stream_id: str, batch_id: int) -> None:
        """Let the catalog find one batch; only that batch's folders are listed."""
        for table in TABLE_SCHEMAS:
            path = spark._jvm.org.apache.hadoop.fs.Path(self.batch_path(table, stream_id, batch_id))
            files = path.getFileSystem(spark._jsc.hadoopConfiguration())
            if not files.exists(path):
                continue
            names = [""]
            if table in DAY_SOURCE:
                days = sorted(f.getPath().getName() for f in files.listStatus(path))
                names = [f", dt = DATE '{day.removeprefix('dt=')}'" for day in days if day.startswith("dt=") and "__" not in day]
            for day in names:
                spark.sql(
                    f"ALTER TABLE `{database}`.{table} ADD IF NOT EXISTS "
                    f"PARTITION (stream_id = '{stream_id}', batch_id = {batch_id}{day})"
                )

    def mark_whole(self, spark: SparkSession, stream_id: str, batch_id: int) -> None:
        """Say that all tables have a batch; from here on reads of whole batches show it."""
        spark.range(1).select(F.lit(1).alias("whole")).coalesce(1).write.mode("overwrite").parquet(self._mark(stream_id, batch_id))

    def unmark(self, spark: SparkSession, stream_id: str, batch_id: int) -> None:
        """Take a batch out of the reads of whole batches, as it is about to be written again."""
        remove(spark, self._mark(stream_id, batch_id))

    def _mark(self, stream_id: str, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/{MARKS}/stream_id={check_stream_id(stream_id)}/batch_id={batch_id}"

    def read(self, spark: SparkSession, table: str, whole_batches: bool = False) -> DataFrame:
        """A stored table, empty before the first batch. Archived rows have no `batch_id`.

        With `whole_batches` a batch shows in all tables or in none: only
        batches whose last write is done are read. Which those are is one row
        a batch, found once and sent to the scan, where it prunes partitions.
        """
        if whole_batches:
            rows = self.read(spark, table)
            marks = f"{self.root.rstrip('/')}/{MARKS}"
            if not exists(spark, marks):
                return rows.where("batch_id IS NULL")
            whole = spark.read.schema(f"whole INT, {BATCH_COLUMNS}").parquet(marks).select("stream_id", "batch_id")
            live = rows.where("batch_id IS NOT NULL").join(F.broadcast(whole), ["stream_id", "batch_id"], "left_semi")
            return live.select(*rows.columns).unionByName(rows.where("batch_id IS NULL"))
        rows = spark.read.schema(TABLE_SCHEMAS[table]).parquet(self.path(table))
        archives = [archive for archive in self.known_archives(spark) if self.archived(spark, archive, table)]
        for archive in archives:
            rows = rows.filter(~archive.holds())
        for archive in archives:
            archived = (
                spark.read.schema(archived_schema(table))
                .parquet(f"{archive.root}/{table}")
                .withColumns({"stream_id": F.lit(archive.stream_id), "batch_id": F.lit(None).cast("long")})
            )
            rows = rows.unionByName(archived)
        return rows

    def archived(self, spark: SparkSession, archive: Archive, table: str) -> bool:
        """Whether an archive has a table; older ones leave dead letters and samples where they are."""
        return table in DAY_SOURCE or exists(spark, f"{archive.root}/{table}")

    @property
    def ids(self) -> IdIndex:
        """The index of the ids in `raw_events`."""
        return IdIndex(self.root)

    def stored_batches(self, spark: SparkSession, table: str) -> list[tuple[str, int]]:
        """The (stream_id, batch_id) that have a partition in a table."""
        return self._batches(spark, self.path(table))

    def marked_batches(self, spark: SparkSession) -> list[tuple[str, int]]:
        """The (stream_id, batch_id) marked as whole."""
        return self._batches(spark, f"{self.root.rstrip('/')}/{MARKS}")

    def _batches(self, spark: SparkSession, folder: str) -> list[tuple[str, int]]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/stream_id=*/batch_id=*")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        names = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found or []]
        return sorted((stream.removeprefix("stream_id="), int(batch.removeprefix("batch_id="))) for stream, batch in names)

    def complete_ids(self, spark: SparkSession) -> list[str]:
        """Write the runs of ids that stored batches and archives still miss, as in tables older than the index."""
        held = [covered(run) for run in self.ids.runs(spark)]

        def missing(stream: str, first: int, end: int) -> bool:
            for a, b in sorted((a, b) for s, a, b in held if s == stream):
                if a <= first < b:
                    first = b
            return first < end

        added = []
        for archive in self.known_archives(spark):
            if missing(archive.stream_id, archive.first_batch, archive.end_batch):
                rows = spark.read.schema(archived_schema("raw_events")).parquet(f"{archive.root}/raw_events")
                added.append(run_name(archive.stream_id, archive.first_batch, archive.end_batch))
                self.ids.write(rows.select("id"), added[-1])
                held.append((archive.stream_id, archive.first_batch, archive.end_batch))
        for stream, batch in self.stored_batches(spark, "raw_events"):
            if missing(stream, batch, batch + 1):
                added.append(run_name(stream, batch))
                self.ids.write(self.read_batch(spark, "raw_events", stream, batch).select("id"), added[-1])
        return added

    def known_archives(self, spark: SparkSession) -> tuple[Archive, ...]:
        """The archives listed in the root, a row each, and those named by this store; none that lies inside another."""
        path = f"{self.root.rstrip('/')}/{ARCHIVE_LIST}"
        listed = []
        if exists(spark, path):
            rows = spark.read.schema(ARCHIVE_SCHEMA).parquet(path).collect()
            listed = [Archive(r.root, r.stream_id, r.first_batch, r.end_batch) for r in rows]
        known = {*listed, *self.archives}
        outer = [a for a in known if not any(b.replaces(a) for b in known)]
        return tuple(sorted(outer, key=lambda a: (a.stream_id, a.first_batch, a.root)))

    def clear_batch(self, spark: SparkSession, table: str, stream_id: str, batch_id: int) -> None:
        """Remove one batch's partition, if it is there."""
        remove(spark, self.batch_path(table, stream_id, batch_id))

    def read_batch(self, spark: SparkSession, table: str, stream_id: str, batch_id: int) -> DataFrame:
        """One batch's partition, read without listing the rest of the table."""
        return spark.read.schema(archived_schema(table)).parquet(self.batch_path(table, stream_id, batch_id))

    def write_batch(self, rows: DataFrame, table: str, stream_id: str, batch_id: int) -> None:
        """Replace one batch's partition, rows sorted for the reads the table serves.

        Rows are first gathered by day, else every task would write a small
        file for every day. The rebalance splits a day that is too large for
        one task and joins small ones.
        """
        path = self.batch_path(table, stream_id, batch_id)
        if table not in DAY_SOURCE:
            rows.write.mode("overwrite").parquet(path)
            return
        by_day = rows.withColumn("dt", F.col(DAY_SOURCE[table]).cast("date")).hint("rebalance", "dt")
        by_day.sortWithinPartitions("dt", *TABLE_SORT[table]).write.mode("overwrite").partitionBy(
            "dt"
        ).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place) and not files.delete(place, True):
        raise OSError(f"could not clear {place}")


def write_for_reading(rows: DataFrame, table: str, path: str) -> None:
    """Write a new version of a table for reading: by day, sorted, evenly sized files.

    The rebalance spreads a day with very many rows over several tasks and
    joins small days, and the row-group statistics follow the sort. The raw
    table gets a bloom filter on `id` for point lookups. Dead letters and
    samples have no days.
    """
    if table not in DAY_SOURCE:
        rows.drop("stream_id", "batch_id").hint("rebalance").write.mode("errorifexists").parquet(path)
        return
    by_day = rows.drop("stream_id", "batch_id").withColumn("dt", F.col(DAY_SOURCE[table]).cast("date"))
    writer = (
        by_day.hint("rebalance", "dt")
        .sortWithinPartitions("dt", *TABLE_SORT[table])
        .write.mode("errorifexists")
        .partitionBy("dt")
    )
    if table == "raw_events":
        writer = writer.option("parquet.bloom.filter.enabled#id", "true")
    writer.parquet(path)


def read_written(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A table that `write_for_reading` wrote."""
    return spark.read.schema(archived_schema(table)).parquet(path)


def archive_batches(
    spark: SparkSession, store: TableStore, stream_id: str, last_committed: int, root: str
) -> TableStore:
    """Rewrite a stream's closed batches below `root`; returns the store that reads them there.

    Only batches before the last committed one are taken: no restart can run
    them again. Rollup rows with equal keys are summed. Nothing in the live
    tables changes, and a failed run leaves only an unused folder behind.
    """
    done = [archive.end_batch for archive in store.known_archives(spark) if archive.stream_id == stream_id]
    archive = Archive(root.rstrip("/"), check_stream_id(stream_id), max(done, default=0), last_committed)
    if archive.end_batch <= archive.first_batch:
        raise ValueError("no closed batches to archive")
    live = TableStore(store.root)
    for table in TABLE_SCHEMAS:
        rows = live.read(spark, table).filter(archive.holds())
        if table == "events_hourly":
            rows = compact_hourly(rows)
        write_for_reading(rows, table, f"{archive.root}/{table}")
    # Listed last: from here on every store on this root reads the archive.
    list_archive(spark, store.root, archive)
    return TableStore(store.root, (*store.archives, archive))


def list_archive(spark: SparkSession, root: str, archive: Archive) -> None:
    """Let every store on this root read an archive, by a file of one row."""
    row = (archive.root, archive.stream_id, archive.first_batch, archive.end_batch)
    spark.createDataFrame([row], ARCHIVE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{ARCHIVE_LIST}")
