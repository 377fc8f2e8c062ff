"""A keyed topic in files with offsets: written by epochs, read by offset ranges, for batches and streams.

A topic is a folder. Data files lie in `partition=P` and hold messages in
order; a commit file per epoch lists which files were added with their first
offsets, the next offset of every partition and the last epoch of every writer.
Files no commit lists do not exist for readers, so an epoch shows as a whole or
not at all, and an epoch that is written again after a failure is left out.

Offsets are JSON, {topic: {partition: next offset}}, as those of brokers are,
so progress shows them and lag is a number. One query writes a topic at a time.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from tidewatch.schemas import DEFAULT_TOPIC, TOPIC_SCHEMA

FORMAT = "topic_log"
PARTITIONS = 3
# Messages one task reads at most; a file may be read by several tasks.
TASK_OFFSETS = 250_000
BATCH_ROWS = 8192

STORED = pa.schema([("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", tz="UTC"))])
MESSAGES = pa.schema(
    [("key", pa.string()), ("value", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))]
)


class Log:
    """The committed files of one topic folder."""

    def __init__(self, path: str):
        uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
        uri = uri if "://" in uri else uri.replace("file:", "file://", 1)
        self.files, self.root = pafs.FileSystem.from_uri(uri)

    def commits(self) -> list[str]:
        """The commit files in order; their names carry the last offsets' place in the log, so the last one says it all."""
        folder = pafs.FileSelector(f"{self.root}/commits", allow_not_found=True)
        return sorted(f.path for f in self.files.get_file_info(folder) if f.base_name.endswith(".json"))

    def read_commit(self, path: str) -> dict:
        with self.files.open_input_stream(path) as stream:
            return json.loads(stream.read())

    def last(self) -> dict:
        found = self.commits()
        return self.read_commit(found[-1]) if found else {"next": {}, "epochs": {}, "added": [], "number": -1}

    def newest(self) -> dict[str, int]:
        """The next offset of every partition that has messages."""
        return self.last()["next"]

    def files_between(self, start: dict[str, int], end: dict[str, int]) -> list[tuple[str, str, int, int]]:
        """(partition, file, first offset, rows) of the files that hold offsets start … end − 1."""
        found = []
        for path in reversed(self.commits()):
            commit = self.read_commit(path)
            for partition, file, first, rows in commit["added"]:
                if first < end.get(partition, 0) and first + rows > start.get(partition, 0):
                    found.append((partition, file, first, rows))
            # All earlier commits are below this one's offsets.
            if all(offset <= start.get(p, 0) for p, offset in commit["next"].items()):
                break
        return sorted(found, key=lambda f: (int(f[0]), f[2]))

    def commit(self, written: Sequence[tuple[str, str, int]], writer: str, epoch: int) -> bool:
        """Give the files (partition, name, rows) their offsets, in this order; False if the epoch is already there."""
        last = self.last()
        if last["epochs"].get(writer, -1) >= epoch:
            for partition, file, _ in written:
                self.files.delete_file(f"{self.root}/partition={partition}/{file}")
            return False
        upto, added = dict(last["next"]), []
        for partition, file, rows in written:
            added.append((partition, file, upto.get(partition, 0), rows))
            upto[partition] = upto.get(partition, 0) + rows
        number = last["number"] + 1
        record = {"number": number, "added": added, "next": upto, "epochs": {**last["epochs"], writer: epoch}}
        self.files.create_dir(f"{self.root}/commits", recursive=True)
        place = f"{self.root}/commits/{number:020d}"
        with self.files.open_output_stream(f"{place}.{uuid.uuid4().hex}.tmp") as stream:
            stream.write(json.dumps(record).encode())
            name = f"{place}.json"
        temporary = [f.path for f in self.files.get_file_info(pafs.FileSelector(f"{self.root}/commits")) if f.path.startswith(place) and f.path.endswith(".tmp")]
        self.files.move(temporary[0], name)
        for left in temporary[1:]:
            self.files.delete_file(left)
        return True

    def drop(self, written: Sequence[tuple[str, str, int]]) -> None:
        for partition, file, _ in written:
            path = f"{self.root}/partition={partition}/{file}"
            if self.files.get_file_info(path).type != pafs.FileType.NotFound:
                self.files.delete_file(path)


@dataclass
class Span(InputPartition):
    """Offsets start … end − 1 of one partition, all in one file that begins at `first`."""

    partition: str
    file: str
    first: int
    start: int
    end: int


def limited(start: dict[str, int], newest: dict[str, int], most: int | None) -> dict[str, int]:
    """The end of a batch of at most `most` messages after `start`: every partition gives its share of what is there."""
    there = {p: newest[p] - start.get(p, 0) for p in newest}
    total = sum(there.values())
    if most is None or total <= most:
        return dict(newest)
    end, spare = {}, most
    for p, n in there.items():
        here = n * most // total
        end[p] = start.get(p, 0) + here
        spare -= here
    for p, n in sorted(there.items(), key=lambda item: -item[1]):
        more = min(spare, newest[p] - end[p])
        end[p] += more
        spare -= more
    return end


class _Reading:
    """What batch and stream readers share: spans of offsets and their messages."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.topic = options.get("topic", DEFAULT_TOPIC)
        self.task_offsets = int(options.get("taskOffsets", TASK_OFFSETS))

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        found = []
        for partition, file, first, rows in Log(self.path).files_between(start, end):
            low, high = max(first, start.get(partition, 0)), min(first + rows, end.get(partition, 0))
            found += [Span(partition, file, first, at, min(at + self.task_offsets, high)) for at in range(low, high, self.task_offsets)]
        for span in found:
            span.value = None
        return found

    def messages(self, span: Span) -> Iterator[pa.RecordBatch]:
        log = Log(self.path)
        with log.files.open_input_file(f"{log.root}/partition={span.partition}/{span.file}") as stream:
            file, at = pq.ParquetFile(stream), span.first
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if at < span.end and at + rows > span.start:
                    here = at
                    for batch in file.iter_batches(BATCH_ROWS, row_groups=[group]):
                        low, high = max(span.start - here, 0), min(span.end - here, batch.num_rows)
                        if low < high:
                            yield self._message(batch.slice(low, high - low), span, here + low)
                        here += batch.num_rows
                at += rows

    def _message(self, batch: pa.RecordBatch, span: Span, offset: int) -> pa.RecordBatch:
        rows = batch.num_rows
        columns = [batch.column("key"), batch.column("value"), pa.array([self.topic] * rows), pa.array([int(span.partition)] * rows, pa.int32())]
        columns += [pa.array(range(offset, offset + rows), pa.int64()), batch.column("timestamp").cast(MESSAGES.field("timestamp").type)]
        return pa.RecordBatch.from_arrays(columns, schema=MESSAGES)


class LogReader(_Reading, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.spans({}, Log(self.path).newest()) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.messages(partition) if isinstance(partition, Span) else iter(())


class LogStreamReader(_Reading, DataSourceStreamReader):
    """Reads from the first offset on; `maxOffsets` bounds a batch, wherever files begin and end."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.most = int(options["maxOffsets"]) if options.get("maxOffsets") else None
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {self.topic: {}}

    def latestOffset(self) -> dict:
        return {self.topic: limited(self.at, Log(self.path).newest(), self.most)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # After a restart this is how the reader learns where the query is.
        self.at = dict(end[self.topic])
        return self.spans(start.get(self.topic, {}), self.at) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.messages(partition) if isinstance(partition, Span) else iter(())

    def commit(self, end: dict) -> None:
        self.at = {**self.at, **end[self.topic]}


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: (partition, name, rows)."""

    files: list[tuple[str, str, int]]


def partition_of(key: str | None, value: str | None, partitions: int) -> int:
    """The partition of a message: by the CRC-32 of its key, without one by that of its value."""
    return zlib.crc32((key if key is not None else value or "").encode()) % partitions


class _Writing:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.count = int(options.get("partitions", PARTITIONS))
        self.writer = options.get("writer", "")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """One file per partition that this task has messages of, in the order they come."""
        log, open_files = Log(self.path), {}
        name = f"{uuid.uuid4().hex}.parquet"
        try:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                columns = [table[c] if c in table.column_names else pa.nulls(batch.num_rows) for c in STORED.names]
                rows = pa.table([c.cast(f.type) for c, f in zip(columns, STORED, strict=True)], schema=STORED)
                keys, values = rows["key"].to_pylist(), rows["value"].to_pylist()
                places: dict[int, list[int]] = {}
                for i, (key, value) in enumerate(zip(keys, values, strict=True)):
                    places.setdefault(partition_of(key, value, self.count), []).append(i)
                for partition, some in places.items():
                    if partition not in open_files:
                        folder = f"{log.root}/partition={partition}"
                        log.files.create_dir(folder, recursive=True)
                        stream = log.files.open_output_stream(f"{folder}/{name}")
                        open_files[partition] = [stream, pq.ParquetWriter(stream, STORED, compression="zstd"), 0]
                    open_files[partition][1].write_table(rows.take(some), row_group_size=BATCH_ROWS)
                    open_files[partition][2] += len(some)
        finally:
            for stream, file, _ in open_files.values():
                file.close()
                stream.close()
        return Written([(str(p), name, rows) for p, (_, _, rows) in sorted(open_files.items())])

    def _files(self, messages) -> list[tuple[str, str, int]]:
        return [f for m in messages if m is not None for f in m.files]


class LogWriter(_Writing, DataSourceArrowWriter):
    """A batch write is one epoch of a writer of its own."""

    def commit(self, messages) -> None:
        Log(self.path).commit(self._files(messages), f"batch-{uuid.uuid4().hex}" if not self.writer else self.writer, 0)

    def abort(self, messages) -> None:
        Log(self.path).drop(self._files(messages))


class LogStreamWriter(_Writing, DataSourceStreamArrowWriter):
    """An epoch's files get their offsets in the order of its tasks; a repeated epoch adds nothing."""

    def commit(self, messages, batchId: int) -> None:
        Log(self.path).commit(self._files(messages), self.writer, batchId)

    def abort(self, messages, batchId: int) -> None:
        Log(self.path).drop(self._files(messages))


class TopicLog(DataSource):
    """`spark.read`, `readStream`, `write` and `writeStream` of format "topic_log" on a topic folder.

    Options: path; topic; maxOffsets (messages of a micro-batch); taskOffsets
    (messages of a task); partitions and writer (name of the writing query, to
    be kept over restarts) for writing.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return TOPIC_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return LogWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return LogStreamWriter(self.options)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session; safe to call repeatedly."""
    spark.dataSource.register(TopicLog)
    return spark


def newest_offsets(path: str, topic: str = DEFAULT_TOPIC) -> dict:
    """The topic's end as progress shows offsets, for lag."""
    return {topic: Log(path).newest()}
