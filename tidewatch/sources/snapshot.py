"""Landed poll responses: files that each hold a JSON array of raw events, or one event per line.

Splitting an array writes each element out again: numbers and spacing may
differ from the file, the values do not. Events landed one per line keep
every byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def explode_snapshots(snapshots: DataFrame, value: str = "value") -> DataFrame:
    """One row per array element as raw JSON `value`; unreadable files keep their text."""
    elements = F.from_json(F.col(value), "array<string>")
    texts = F.transform(elements, lambda element: F.coalesce(element, F.lit("null")))
    whole = F.array(F.col(value))
    others = [name for name in snapshots.columns if name != value]
    return snapshots.select(
        *others, F.explode(F.coalesce(texts, whole)).alias("value")
    )


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of array files."""
    return explode_snapshots(spark.read.text(path, wholetext=True))


def stream_snapshots(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of array files as they land."""
    reader = spark.readStream.option("wholetext", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return explode_snapshots(reader.text(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of files with one raw event per line, bytes unchanged."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of files with one raw event per line, bytes unchanged."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)
