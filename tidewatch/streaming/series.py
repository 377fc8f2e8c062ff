"""Counter increases as a stream: the last sample of every series is the state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_PAIRS = "array<struct<key:string,value:string>>"


def stream_increases(samples: DataFrame, window_seconds: int, expiry_seconds: int = 86400) -> DataFrame:
    """(metric, labels, window_start, increase) rows of each batch; `sum_increases` adds them up.

    However the samples are split into batches, the sums are those of
    `operators.metrics.increases` over the whole table, as long as no series
    goes back in time between batches: a sample not newer than the last one
    taken adds nothing. A drop is a restart, the first sample of a series adds
    nothing. A series silent for `expiry_seconds` of event time is forgotten and starts
    anew, and a sample as far behind the newest of all series is left out, as
    are samples without time or value. A task holds one batch's samples of a
    series.
    """
    step = int(window_seconds) * 1_000_000
    pairs = F.to_json(F.array_sort(F.map_entries(F.coalesce("labels", F.create_map().cast("map<string,string>")))))
    timed = samples.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).withWatermark("ts", f"{expiry_seconds} seconds")
    given = timed.select(
        "ts", "metric", pairs.alias("_series"), F.unix_micros("ts").alias("_at"), F.col("value").cast("double").alias("value")
    )

    def taken(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat([chunk[["_at", "value"]] for chunk in chunks]).sort_values("_at", kind="stable").drop_duplicates("_at")
        last, previous = state.get if state.exists else (None, None)
        if last is not None:
            rows = rows[rows["_at"] > last]
        newest = int(rows["_at"].iloc[-1]) if len(rows) else last
        # The watermark is the newest time less the expiry, so a state's own last time is when it ends.
        state.setTimeoutTimestamp(max(newest // 1000, state.getCurrentWatermarkMs()) + 1)
        if not len(rows):
            return
        value = rows["value"].to_numpy()
        before = rows["value"].shift().to_numpy(copy=True)
        before[0] = value[0] if previous is None else previous
        delta = pd.Series(value - before).where(value >= before, value)
        windows = (rows["_at"] // step * step).to_numpy()
        state.update((newest, float(value[-1])))
        found = delta.groupby(windows).sum()
        yield pd.DataFrame({"metric": key[0], "_series": key[1], "_window": found.index, "increase": found.to_numpy()})

    found = given.groupBy("metric", "_series").applyInPandasWithState(
        taken,
        "metric string, _series string, _window long, increase double",
        "at long, value double",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    labels = F.map_from_entries(F.from_json("_series", _PAIRS)).alias("labels")
    return found.select("metric", labels, F.timestamp_micros("_window").alias("window_start"), "increase")


def sum_increases(parts: DataFrame) -> DataFrame:
    """One row per series and window from the rows of all batches."""
    series = F.array_sort(F.map_entries("labels")).alias("_series")
    summed = parts.groupBy("metric", series, "window_start").agg(F.sum("increase").alias("increase"))
    return summed.select("metric", F.map_from_entries("_series").alias("labels"), "window_start", "increase")
