"""Known event ids: immutable runs of ids, parted by hash, and a Bloom filter per run and part kept as rows.

A batch asks whether its ids are stored without scanning the stored events: it
reads the filters, three bytes an id, and opens only those files of those runs
whose filter says that one of its ids may be there. New ids in whatever order
open next to none, however many runs there are.

Each batch writes one run under its own name, so a batch that runs again
replaces its run. Runs are sets: an id in two of them is known all the same.
So merging writes the merged run first and removes the merged ones afterwards,
and stopping anywhere in between changes no answer. A run's ids are written
before its filters, and removed after them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A batch of few ids is probed in up to this many buckets of the hash; a power of two, as are parts and files.
BUCKETS = 64
BITS_PER_ID = 24
LEAST_BITS = 1024
HASHES = 12
# Ids of one filter row and of one file at most, about.
ROW_IDS = 1 << 12
FILE_IDS = 1 << 18
# Ids of a batch, and runs, that are probed together, about.
PROBE_IDS = 1 << 14
PROBE_RUNS = 1 << 9

FILTER_SCHEMA = "part BIGINT, parts BIGINT, files BIGINT, ids BIGINT, bits BINARY, run STRING"


def _power(n: int, most: int) -> int:
    """The least power of two that parts `n` ids in pieces of `most` on average."""
    return 1 << max(0, -(-n // most) - 1).bit_length()


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """The bits of each id in a filter of `size` bits."""
    steps = np.arange(HASHES, dtype=np.uint64)[None, :]
    return (h1.view(np.uint64)[:, None] + steps * (h2.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(size)


def _hashed(ids: DataFrame) -> DataFrame:
    return ids.select("id", F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"))


def _row_filter(rows: pd.DataFrame) -> pd.DataFrame:
    """The filter row of the ids (h1, h2) of one part."""
    size = max(LEAST_BITS, 8 * -(-len(rows) * BITS_PER_ID // 8))
    bits = np.zeros(size, bool)
    bits[_places(rows["h1"].to_numpy(), rows["h2"].to_numpy(), size).ravel()] = True
    first = rows.iloc[0]
    values = [[int(first["part"]), int(first["parts"]), int(first["files"]), len(rows), np.packbits(bits).tobytes()]]
    return pd.DataFrame(values, columns=["part", "parts", "files", "ids", "bits"])


def _probe(filters: pa.Table, ids: pa.Table) -> pa.Table:
    """(run, file) of the filter rows of a bucket that may hold one of the bucket's ids."""
    h1, h2 = ids["h1"].to_numpy(), ids["h2"].to_numpy()
    columns = [filters[name] for name in ("run", "part", "files", "bits")]
    hits = []
    for i in range(filters.num_rows if len(h1) else 0):
        run, part, files, packed = (column[i].as_py() for column in columns)
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        if bits[_places(h1, h2, len(bits)).view(np.int64)].all(axis=1).any():
            hits.append((run, part % files))
    return pa.table({"run": pa.array([h[0] for h in hits], pa.string()), "file": pa.array([h[1] for h in hits], pa.int64())})


def run_name(stream_id: str, first: int, end: int | None = None) -> str:
    """The run of one batch, or of batches first … end − 1."""
    return f"{stream_id}~{first}" if end is None else f"{stream_id}~{first}-{end}"


def covered(name: str) -> tuple[str, int, int]:
    """(stream, first, end) of the batches whose ids a run holds."""
    stream, _, batches = name.rpartition("~")
    first, _, end = batches.partition("-")
    return stream, int(first), int(end) if end else int(first) + 1


@dataclass(frozen=True)
class IdIndex:
    """The known ids below `root`, a folder every executor can reach."""

    root: str

    def ids_path(self, run: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/known_ids" + (f"/run={run}" if run else "")

    def filters_path(self, run: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/known_id_filters" + (f"/run={run}" if run else "")

    def runs(self, spark: SparkSession) -> list[str]:
        """The names of the runs whose filters are written; one listing of their folders."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.filters_path()}/run=*/part-*")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted({f.getPath().getParent().getName().removeprefix("run=") for f in found or []})

    def write(self, ids: DataFrame, run: str) -> None:
        """Replace one run by these ids (column id, without nulls)."""
        spark = ids.sparkSession
        rows = ids.count()
        parts, files = _power(rows, ROW_IDS), _power(rows, FILE_IDS)
        placed = _hashed(ids).select("id", F.pmod("h2", F.lit(files)).alias("file"))
        by_file = placed.repartition("file") if files > 1 else placed.coalesce(1)
        by_file.sortWithinPartitions("file", "id").write.mode("overwrite").partitionBy("file").parquet(self.ids_path(run))
        written = spark.read.schema("id STRING").parquet(self.ids_path(run))
        about = {"part": F.pmod("h2", F.lit(parts)), "parts": F.lit(parts).cast("long"), "files": F.lit(files).cast("long")}
        filters = _hashed(written).withColumns(about).groupBy("part").applyInPandas(_row_filter, FILTER_SCHEMA.rsplit(", run", 1)[0])
        # One file, so that the run's filters appear as a whole; many tasks make them.
        filters.repartition(1).write.mode("overwrite").parquet(self.filters_path(run))

    def remove(self, spark: SparkSession, run: str) -> None:
        for path in (self.filters_path(run), self.ids_path(run)):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = place.getFileSystem(spark._jsc.hadoopConfiguration())
            if files.exists(place) and not files.delete(place, True):
                raise OSError(f"could not remove {path}")

    def dealt(self, ids: DataFrame, skip: str | None = None) -> tuple[DataFrame, DataFrame]:
        """The filter rows (run, part, files, bits) and the hashes of `ids` (h1, h2), both by (level, bucket, slice).

        A filter row meets only ids of its part. Ids are dealt to as many
        buckets as the run has parts, for runs of few parts to so many that
        some thousands are in each; a filter of fewer parts goes to several
        buckets and is small then. Many runs are dealt to slices. So a bucket
        holds no more ids or filter rows when batches or runs grow, and an id
        is sent once for each size of runs.
        """
        filters = ids.sparkSession.read.schema(FILTER_SCHEMA).parquet(self.filters_path())
        if skip is not None:
            filters = filters.where(F.col("run") != skip)
        ids = ids.where(F.col("id").isNotNull())
        rows = ids.count()
        least = max(_power(rows, PROBE_IDS), min(BUCKETS, _power(rows, ROW_IDS)))
        slices = _power(len(self.runs(ids.sparkSession)), PROBE_RUNS)
        filters = filters.withColumn("level", F.greatest("parts", F.lit(least).cast("long")))
        levels = [row.level for row in filters.select("level").distinct().collect()]
        bucket = F.explode(F.sequence("part", F.col("level") - 1, "parts")).alias("bucket")
        by_slice = F.pmod(F.xxhash64("run"), F.lit(slices).cast("long")).alias("slice")
        filters = filters.select("run", "part", "files", "bits", "level", bucket, by_slice)
        hashed = _hashed(ids).select("h1", "h2", F.explode(F.lit(levels).cast("array<long>")).alias("level"))
        every_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
        return filters, hashed.select("h1", "h2", "level", F.pmod("h2", "level").alias("bucket"), every_slice)

    def hits(self, ids: DataFrame, skip: str | None = None) -> list[tuple[str, int]]:
        """The (run, file) that may hold one of `ids`, `skip`'s left out.

        What is collected is a part of the list of files that reading the
        table would list anyway.
        """
        key = ["level", "bucket", "slice"]
        filters, hashed = (rows.groupBy(*key) for rows in self.dealt(ids, skip))
        found = filters.cogroup(hashed).applyInArrow(_probe, "run STRING, file BIGINT")
        return sorted((row.run, row.file) for row in found.distinct().collect())

    def candidates(self, ids: DataFrame, skip: str | None = None) -> DataFrame:
        """Known ids among which all known ones of `ids` are: those of the files that `hits` names."""
        spark = ids.sparkSession
        if not [run for run in self.runs(spark) if run != skip]:
            return spark.createDataFrame([], "id STRING")
        paths = [f"{self.ids_path(run)}/file={file}" for run, file in self.hits(ids, skip)]
        return spark.read.schema("id STRING").option("basePath", self.ids_path()).parquet(*paths).select("id") if paths else spark.createDataFrame([], "id STRING")

    def merge(self, spark: SparkSession, stream_id: str, end_batch: int, fan: int = 8) -> str | None:
        """Merge the closed runs of a stream, those of batches before `end_batch`, by size class.

        A class holds runs of fan^k to fan^(k+1) − 1 batches; the first `fan`
        neighbouring runs of the lowest class that has so many become one. So
        the number of runs grows with the logarithm of the batches, and an id
        is written again once per class. Returns the new run's name, or None
        when no class is full.
        """
        spans = sorted(covered(run) for run in self.runs(spark))
        closed = [(first, end) for stream, first, end in spans if stream == stream_id and end <= end_batch]
        # A run inside another one is left over from a merge that was stopped.
        outer = [s for s in closed if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in closed)]
        for first, end in set(closed) - set(outer):
            self._remove_span(spark, stream_id, first, end)
        size = 1
        while outer and size <= max(end - first for first, end in outer):
            for at in range(len(outer) - fan + 1):
                some = outer[at : at + fan]
                joined = all(a[1] == b[0] for a, b in zip(some, some[1:]))
                if joined and all(size <= end - first < size * fan for first, end in some):
                    return self._merged(spark, stream_id, some)
            size *= fan
        return None

    def _merged(self, spark: SparkSession, stream_id: str, some: list[tuple[int, int]]) -> str:
        names = [run_name(stream_id, first, None if end == first + 1 else end) for first, end in some]
        run = run_name(stream_id, some[0][0], some[-1][1])
        ids = spark.read.schema("id STRING").option("basePath", self.ids_path()).parquet(*[self.ids_path(name) for name in names])
        self.write(ids.select("id").distinct(), run)
        for name in names:
            self.remove(spark, name)
        return run

    def _remove_span(self, spark: SparkSession, stream_id: str, first: int, end: int) -> None:
        self.remove(spark, run_name(stream_id, first, None if end == first + 1 else end))
