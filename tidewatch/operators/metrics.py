"""Queries over metric samples: rates, increases, gauges, histograms, quantiles.

`samples` is (ts, metric, labels MAP, value); a series is a metric with one
set of labels and has one sample per instant. Increases are plain deltas
without extrapolation: the first sample of a series adds nothing, and a drop
means the counter restarted, so the new value is the delta.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.timebuckets import instant
from tidewatch.schemas import DEFAULT_BUCKETS
from tidewatch.session import working_folder

SERIES = ("metric", "_series")


def _with_series(samples: DataFrame) -> DataFrame:
    # Maps have no order, so a series is named by its sorted label pairs.
    return samples.withColumn("_series", F.array_sort(F.map_entries("labels")))


def _delta(value: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), F.lit(0.0)).when(value < previous, value).otherwise(value - previous)
    )


def increases(samples: DataFrame, window_seconds: int) -> DataFrame:
    """Counter increase per series and tumbling window.

    Deltas are taken inside each (series, window) group and the step from one
    window to the next is added from the windows' last values, so no task
    reads a long series from end to end.
    """
    grouped = _with_series(samples).withColumn(
        "window_start", F.window("ts", f"{window_seconds} seconds")["start"]
    )
    inside = Window.partitionBy(*SERIES, "window_start").orderBy("ts")
    per_window = (
        grouped.withColumn("_delta", _delta(F.col("value"), F.lag("value").over(inside)))
        .groupBy(*SERIES, "window_start")
        .agg(
            F.sum("_delta").alias("_inside"),
            F.min_by("value", "ts").alias("_first"),
            F.max_by("value", "ts").alias("_last"),
        )
    )
    across = Window.partitionBy(*SERIES).orderBy("window_start")
    step = _delta(F.col("_first"), F.lag("_last").over(across))
    return per_window.withColumn("_step", step).select(
        "metric",
        F.map_from_entries("_series").alias("labels"),
        "window_start",
        (F.col("_inside") + F.col("_step")).alias("increase"),
    )


def rate(
    samples: DataFrame,
    metric: str,
    window_seconds: int,
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Per-second rate of a counter per window, summed over series, by label."""
    chosen = samples.filter(F.col("metric") == metric)
    if where is not None:
        chosen = chosen.filter(where)
    return (
        increases(chosen, window_seconds)
        .groupBy("window_start", *[F.col("labels")[label].alias(label) for label in by])
        .agg((F.sum("increase") / F.lit(float(window_seconds))).alias("rate"))
    )


def server_errors(label: str = "status") -> Column:
    """Samples whose status label is 5xx."""
    return F.col("labels")[label].rlike("^5..$")


def increase_since(
    samples: DataFrame, metric: str, as_of: datetime | Column, minutes: int = 15
) -> DataFrame:
    """Total increase of a counter in the last `minutes` before `as_of`.

    What lies before the window only gives each series its starting value,
    found by aggregation; only the window's own samples are ordered.
    """
    end = instant(as_of)
    start = end - F.make_dt_interval(mins=F.lit(minutes))
    chosen = _with_series(samples.filter((F.col("metric") == metric) & (F.col("ts") <= end)))
    baseline = (
        chosen.filter(F.col("ts") <= start)
        .groupBy(*SERIES)
        .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
        .withColumn("_counted", F.lit(False))
    )
    recent = chosen.filter(F.col("ts") > start).withColumn("_counted", F.lit(True))
    columns = [*SERIES, "ts", "value", "_counted"]
    ordered = Window.partitionBy(*SERIES).orderBy("ts")
    return (
        baseline.select(*columns)
        .unionByName(recent.select(*columns))
        .withColumn("_delta", _delta(F.col("value"), F.lag("value").over(ordered)))
        .agg(F.coalesce(F.sum(F.when(F.col("_counted"), F.col("_delta"))), F.lit(0.0)).alias("increase"))
    )


def latest(samples: DataFrame, metric: str) -> DataFrame:
    """The newest value of every series of a gauge."""
    return (
        _with_series(samples.filter(F.col("metric") == metric))
        .groupBy(*SERIES)
        .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
        .select("metric", F.map_from_entries("_series").alias("labels"), "ts", "value")
    )


def total(samples: DataFrame, metric: str) -> DataFrame:
    """The newest values of a counter, summed over its series."""
    return latest(samples, metric).groupBy("metric").agg(F.sum("value").alias("total"))


def bound_label(bound: float) -> str:
    return format(bound, "g")


def histogram(
    observations: DataFrame,
    value: str,
    by: Sequence[str] = (),
    buckets: Sequence[float] = DEFAULT_BUCKETS,
) -> DataFrame:
    """Cumulative bucket counts (`le`, `count`) of the observed values.

    All buckets are counted in one pass and unfolded after the aggregation.
    """
    counts = observations.groupBy(*by).agg(
        *[F.count_if(F.col(value) <= bound).alias(f"_b{i}") for i, bound in enumerate(buckets)],
        F.count(value).alias("_all"),
    )
    rows = [
        F.struct(F.lit(bound_label(bound)).alias("le"), F.col(f"_b{i}").alias("count"))
        for i, bound in enumerate(buckets)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("count")))
    return counts.select(*by, F.inline(F.array(*rows)))


def histogram_quantile(
    buckets: DataFrame, quantile: float, by: Sequence[str] = (), count: str = "count"
) -> DataFrame:
    """The quantile of cumulative buckets, interpolated inside the bucket it falls in.

    A rank above the largest finite bound gives that bound. Groups without
    observations give no row. A group is as small as the bucket list.
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").try_cast("double"))
    if by:
        everything = Window.partitionBy(*by)
        ordered = Window.partitionBy(*by).orderBy("_bound")
    else:
        everything = Window.partitionBy(F.lit(0))
        ordered = everything.orderBy("_bound")
    ranked = (
        buckets.withColumn("_bound", bound)
        .withColumn("_count", F.col(count).cast("double"))
        .withColumn("_total", F.max("_count").over(everything))
        .withColumn("_below", F.lag("_count", 1, 0.0).over(ordered))
        .withColumn("_lower", F.lag("_bound", 1, 0.0).over(ordered))
        .withColumn("_rank", F.lit(quantile) * F.col("_total"))
        .filter((F.col("_below") < F.col("_rank")) & (F.col("_count") >= F.col("_rank")))
    )
    inside = (F.col("_rank") - F.col("_below")) / (F.col("_count") - F.col("_below"))
    value = F.when(F.col("le") == "+Inf", F.col("_lower")).otherwise(
        F.col("_lower") + (F.col("_bound") - F.col("_lower")) * inside
    )
    return ranked.select(*by, F.col("_total").alias("observations"), value.alias("quantile"))


def quantile_of_rates(
    samples: DataFrame, metric: str, window_seconds: int, quantile: float = 0.95
) -> DataFrame:
    """Quantile per window of a histogram stored as `<metric>_bucket` counters, over all series."""
    buckets = rate(samples, f"{metric}_bucket", window_seconds, by=("le",))
    return histogram_quantile(buckets, quantile, by=("window_start",), count="rate").select(
        "window_start", "quantile"
    )


def exact_quantile(
    rows: DataFrame, value: str, quantile: float, by: Sequence[str] = (), pieces: int = 1024
) -> DataFrame:
    """(by …, observations, quantile): the interpolated quantile of each group's values, exact for groups of any size.

    The rank is looked for by counting: each round parts the range that holds
    it in `pieces` and keeps the piece with the rank, until one value is left.
    A round is a partly aggregated count, at most `pieces` rows a task and
    rank, so no task ever holds or sorts a group; the range shrinks by
    `pieces` each time. Nulls and NaN are left out; groups without values give
    no row.
    """
    spark = rows.sparkSession
    keys = [F.col(c) for c in by] or [F.lit(0)]
    names = [f"_g{i}" for i in range(len(keys))]
    values = rows.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).cast("double").alias("_v"))
    values = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sized = values.groupBy(*names).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    position = (F.col("_n") - 1) * F.lit(float(quantile))
    ranks = F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position))))
    state = sized.select(*names, "_n", ranks.alias("_rank"), "_low", "_high").withColumn("_left", F.col("_rank"))
    while True:
        folder = working_folder(spark, "ranks")
        state.write.parquet(folder)
        state = spark.read.schema(state.schema).parquet(folder)
        wide = state.where("_low < _high")
        if not wide.limit(1).count():
            break
        sought = wide.select(*[F.col(n).alias(f"_of{n}") for n in names], "_n", "_rank", "_left", "_low", "_high")
        same = [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names] + [F.col("_v").between(F.col("_low"), F.col("_high"))]
        place = F.floor((F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2) * pieces)
        endless = (F.abs("_low") == float("inf")) | (F.abs("_high") == float("inf"))
        # The ends are always in different pieces, so every round narrows the range.
        piece = F.when(F.col("_v") == F.col("_low"), 0).when(F.col("_v") == F.col("_high"), pieces - 1).when(endless, 1)
        piece = piece.otherwise(F.greatest(F.lit(0), F.least(F.lit(pieces - 1), place)))
        inside = [*names, "_n", "_rank", "_left"]
        counted = values.join(sought, same).select(*inside, piece.alias("_piece"), "_v")
        counted = counted.groupBy(*inside, "_piece").agg(F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        before = Window.partitionBy(*names, "_rank").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_below", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        held = counted.where((F.col("_below") <= F.col("_left")) & (F.col("_left") < F.col("_below") + F.col("_c")))
        held = held.select(*names, "_n", "_rank", "_low", "_high", (F.col("_left") - F.col("_below")).alias("_left"))
        state = state.where("_low >= _high").unionByName(held)
    low, high = F.min("_low"), F.max("_low")
    part = (F.col("_n") - 1) * F.lit(float(quantile))
    found = state.groupBy(*names, "_n").agg(low.alias("_low"), high.alias("_high"))
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        F.col("_low") + (F.col("_high") - F.col("_low")) * (part - F.floor(part))
    )
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, by)], F.col("_n").alias("observations"), between.alias("quantile")
    )


def request_summary(
    requests: DataFrame, by: Sequence[str] = ("method", "path", "status"), duration: str = "duration"
) -> DataFrame:
    """Requests and p95 duration per method, path and status."""
    summary = histogram_quantile(histogram(requests, duration, by), 0.95, by)
    return summary.select(
        *by, F.col("observations").cast("long").alias("requests"), F.col("quantile").alias("p95_seconds")
    )
