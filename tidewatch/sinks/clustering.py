"""Raw events clustered for two access paths: newest of a repository, and newest of all.

Sorted by repository, a day's newest events lie in all of its files; sorted by
time, a repository's do. Here rows follow the interleaved bits of their
repository's rank and of their time of day, so a file holds a range of
repositories during a part of a day. A row per file states its bounds, and a
read opens only the files whose bounds can hold what it asks for.

Events have a repository and a time by contract.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.schemas import EVENT_COLUMNS, EVENT_SCHEMA

# Bits of a rank: a day is cut into 2^BITS ranges of repositories and as many of time.
BITS = 6
FILE_ROWS = 1_000_000
# Ranges of names that are summed on their own to find the ranks.
NAME_RANGES = 64
DAY_MICROS = 86_400_000_000

BOUNDS_SCHEMA = (
    "dt DATE, file STRING, rows BIGINT, first_repo STRING, last_repo STRING, first_at TIMESTAMP, last_at TIMESTAMP"
)


def rank_starts(events: DataFrame, path: str, bits: int = BITS) -> list[tuple[str, int]]:
    """The first name of every rank but 0, with the rank: the share of the events before a name in steps of 2^-bits.

    A name with many events takes the place of several ranks, which stay empty.

    Counts per name are written below `path` by ranges of names, so that each
    range is summed in a task of its own; only the ranges' totals and the
    names found are collected.
    """
    spark = events.sparkSession
    counts = events.where("repo_name IS NOT NULL").groupBy("repo_name").agg(F.count("*").alias("n"))
    by_range = counts.repartitionByRange(NAME_RANGES, "repo_name").withColumn("part", F.spark_partition_id())
    by_range.write.mode("overwrite").parquet(path)
    counts = spark.read.schema("repo_name STRING, n BIGINT, part INT").parquet(path)
    sizes = {row.part: row.n for row in counts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    total, before, rows = sum(sizes.values()), 0, []
    for part in sorted(sizes):
        rows.append((part, before))
        before += sizes[part]
    if not total:
        return []
    offsets = F.broadcast(spark.createDataFrame(rows, "part INT, before BIGINT"))
    earlier = Window.partitionBy("part").orderBy("repo_name").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.join(offsets, "part").withColumn(
        "before", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    )
    # A rank starts at its first name, if a name starts in it.
    rank = F.floor(F.col("before") * (1 << bits) / total)
    first = counts.groupBy(rank.alias("rank")).agg(F.min("repo_name").alias("name")).where("rank > 0")
    return sorted((row.name, row.rank) for row in first.collect())


def rank_of(name: str, starts: list[tuple[str, int]]) -> Column:
    """The rank of a name, 0 before the first start."""
    if not starts:
        return F.lit(0)
    passed = [F.when(F.col(name) >= start, rank) for start, rank in starts]
    return F.greatest(F.lit(0), *passed)


def interleaved(first: Column, second: Column, bits: int) -> Column:
    """Two ranks of so many bits as one number, bit by bit, `first` leading."""
    def spread(rank: Column, to: int) -> list[Column]:
        return [F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)), 2 * i + to) for i in range(bits)]

    return reduce(lambda a, b: a.bitwiseOR(b), [*spread(first, 1), *spread(second, 0)])


def write_clustered(
    events: DataFrame, path: str, file_rows: int = FILE_ROWS, bits: int = BITS
) -> None:
    """Write events by day and cluster, with the bounds of every file.

    The range shuffle splits a repository with very many events by time, and
    one busy moment by id, so files stay even. Bounds are written last: a
    folder without them is not whole.
    """
    spark = events.sparkSession
    starts = rank_starts(events, f"{path}/ranks", bits)
    of_day = F.unix_micros("created_at") - F.unix_micros(F.date_trunc("day", "created_at"))
    moment = F.floor(of_day * (1 << bits) / DAY_MICROS).cast("int")
    rows = events.select(*EVENT_COLUMNS).withColumns(
        {"dt": F.col("created_at").cast("date"), "cluster": interleaved(rank_of("repo_name", starts).cast("int"), moment, bits)}
    )
    order = ["dt", "cluster", "repo_name", "created_at", "id"]
    files = max(1, -(-events.count() // file_rows))
    (
        rows.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop("cluster")
        .write.mode("overwrite")
        .partitionBy("dt")
        .parquet(f"{path}/rows")
    )
    written = spark.read.schema(f"{EVENT_SCHEMA}, dt DATE").parquet(f"{path}/rows")
    bounds = written.groupBy("dt", F.regexp_extract("_metadata.file_path", "(dt=[^/]*/[^/]+)$", 1).alias("file")).agg(
        F.count("*").alias("rows"),
        F.min("repo_name").alias("first_repo"),
        F.max("repo_name").alias("last_repo"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BOUNDS_SCHEMA).parquet(f"{path}/bounds")


def _read(spark: SparkSession, path: str, bounds: DataFrame) -> DataFrame:
    """The rows of some files. Their names are part of what listing the folder would give the driver anyway."""
    schema = f"{EVENT_SCHEMA}, dt DATE"
    files = [f"{path}/rows/{row.file}" for row in bounds.select("file").collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*files)


def of_repository(spark: SparkSession, path: str, repo: str) -> DataFrame:
    """The events of a repository, from the files whose range of names holds it."""
    held = read_bounds(spark, path).where((F.col("first_repo") <= repo) & (F.col("last_repo") >= repo))
    return _read(spark, path, held).where(F.col("repo_name") == repo)


def newest(spark: SparkSession, path: str, least: int) -> DataFrame:
    """Events among which the `least` newest of all are, from the files that may hold one.

    The files that start last and hold so many events together start at some
    time; what ends before it holds none of them.
    """
    bounds = read_bounds(spark, path)
    # A row per file.
    later = Window.orderBy(F.desc("first_at"), "file").rowsBetween(Window.unboundedPreceding, -1)
    needed = bounds.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0))).where(F.col("later") < least)
    since = needed.agg(F.min("first_at")).first()[0]
    if since is None:
        return _read(spark, path, bounds)
    return _read(spark, path, bounds.where(F.col("last_at") >= F.lit(since))).where(F.col("created_at") >= F.lit(since))
