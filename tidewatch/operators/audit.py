"""Checks that the tables agree with each other and with the topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.params import required_name

# Offsets per bitmap of Spark's bitmap functions.
BITMAP_SPAN = 32768


def duplicate_ids(raw: DataFrame) -> DataFrame:
    """Ids stored more than once."""
    return raw.groupBy("id").agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def id_summary(raw: DataFrame, event_id: str) -> DataFrame:
    """How often an id is stored, and its type."""
    return raw.filter(F.col("id") == required_name("id", event_id)).agg(
        F.count("*").alias("count"), F.max("type").alias("type")
    )


def repo_totals(hourly: DataFrame, timeseries: DataFrame, repo: str) -> DataFrame:
    """A repository's events by the rollup and by the time series, in one row."""
    repo = required_name("repo", repo)
    mine = F.col("repo_name") == repo
    counted = hourly.filter(mine).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).scalar()
    return timeseries.filter(mine).agg(F.count("*").alias("timeseries_rows")).select(
        F.lit(repo).alias("repo_name"), counted.alias("hourly_count"), "timeseries_rows"
    )


def prefix_totals(raw: DataFrame, hourly: DataFrame, prefix: str) -> DataFrame:
    """Rows of one load run, whose ids start `prefix-` and repositories `prefix/`."""
    prefix = required_name("prefix", prefix)
    counted = (
        hourly.filter(F.col("repo_name").startswith(f"{prefix}/"))
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
        .scalar()
    )
    return raw.filter(F.col("id").startswith(f"{prefix}-")).agg(
        F.count("*").alias("raw_rows")
    ).select("raw_rows", counted.alias("hourly_count"))


def reconcile_stores(published: DataFrame, raw: DataFrame, hourly: DataFrame) -> DataFrame:
    """Per repository and type: published events, raw rows, rollup count, and the differences.

    The rows of a full outer join of the three counts, a key missing on one
    side counting 0 there, but from one aggregation of their union: one
    shuffle of pre-aggregated counts, and NULL keys compare as equal.
    """
    counts = ("published", "raw_rows", "hourly_count")

    def side(rows: DataFrame, event_type: str, name: str, amount: Column) -> DataFrame:
        zero = F.lit(0).cast("long")
        return rows.select(
            "repo_name",
            F.col(event_type).alias("event_type"),
            *[(amount if count == name else zero).alias(count) for count in counts],
        )

    one = F.lit(1).cast("long")
    return (
        side(published, "type", "published", one)
        .unionByName(side(raw, "type", "raw_rows", one))
        .unionByName(side(hourly, "event_type", "hourly_count", F.col("count")))
        .groupBy("repo_name", "event_type")
        .agg(*[F.sum(count).alias(count) for count in counts])
        .withColumns(
            {
                "raw_diff": F.col("published") - F.col("raw_rows"),
                "hourly_diff": F.col("hourly_count") - F.col("raw_rows"),
            }
        )
    )


def _bit_is_clear(bitmap: str, position: Column) -> Column:
    octet = F.substring(F.col(bitmap), (position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(octet), 16, 10).cast("int"), (position % 8).cast("int")) == 0


def _progress(messages: DataFrame, done: Column | str) -> DataFrame:
    """(topic, partition, first_offset, latest_offset, contiguous_offset), from one pass over the messages.

    Completion is kept as one bit per offset in bitmaps of `BITMAP_SPAN`,
    merged before the shuffle and blind to repeats, so a partition of any
    length comes down to a few small rows and no partition is read through by
    one task. Each span also announces the next one: an announced span without
    messages is a gap, and so is the end.
    """
    done = F.col(done) if isinstance(done, str) else done
    keys = ["topic", "partition"]
    spans = (
        messages.withColumn("_done", done)
        .groupBy(*keys, F.floor(F.col("offset") / BITMAP_SPAN).alias("_span"))
        .agg(
            F.min("offset").alias("_low"),
            F.max("offset").alias("_high"),
            F.bitmap_construct_agg(F.when(F.col("_done"), F.col("offset") % BITMAP_SPAN)).alias("_bits"),
        )
    )
    here = F.struct(F.col("_span"), F.lit(True).alias("_here"), "_low", "_high", "_bits")
    following = F.struct(
        (F.col("_span") + 1).alias("_span"),
        F.lit(False).alias("_here"),
        F.lit(None).cast("long").alias("_low"),
        F.lit(None).cast("long").alias("_high"),
        F.lit(None).cast("binary").alias("_bits"),
    )
    announced = spans.select(*keys, F.inline(F.array(here, following)))
    merged = announced.groupBy(*keys, "_span").agg(
        F.bool_or("_here").alias("_here"),
        F.bool_or(~F.col("_here")).alias("_follows"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
        F.max("_bits").alias("_bits"),
    )
    # A span that nothing announced is the first, or comes after a gap found before it.
    begin = F.col("_span") * BITMAP_SPAN
    gap_before = ~F.col("_here") | (F.col("_follows") & (F.col("_low") > begin))
    full = F.bitmap_count("_bits") == begin + BITMAP_SPAN - F.col("_low")
    broken = F.struct("_span", gap_before.alias("_before"), "_low", "_bits")
    ends = merged.groupBy(*keys).agg(
        F.min("_low").alias("first_offset"),
        F.max("_high").alias("latest_offset"),
        F.min(F.when(gap_before | ~full, broken)).alias("g"),
    )
    ends = ends.select(*keys, "first_offset", "latest_offset", "g.*")
    clear = F.filter(
        F.sequence((F.col("_low") % BITMAP_SPAN).cast("int"), F.lit(BITMAP_SPAN - 1)),
        lambda p: _bit_is_clear("_bits", p),
    )
    end = begin + F.when(F.col("_before"), 0).otherwise(F.get(clear, F.lit(0))) - 1
    contiguous = F.when(end >= F.col("first_offset"), end)
    return ends.select(*keys, "first_offset", "latest_offset", contiguous.alias("contiguous_offset"))


def contiguous_offsets(messages: DataFrame, done: Column | str) -> DataFrame:
    """The highest offset per (topic, partition) up to which every message is done.

    NULL when the first message is not done.
    """
    return _progress(messages, done).select("topic", "partition", "contiguous_offset")


def topic_lag(messages: DataFrame, done: Column | str) -> DataFrame:
    """Messages per (topic, partition) after the last contiguous completed offset."""
    behind = F.coalesce(F.col("contiguous_offset"), F.col("first_offset") - 1)
    return _progress(messages, done).select(
        "topic", "partition", "latest_offset", "contiguous_offset", (F.col("latest_offset") - behind).alias("lag")
    )


def load_summary(events: DataFrame, run: str, at: str = "created_at") -> DataFrame:
    """Events, elapsed seconds and events per second of each run."""
    elapsed = (F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / F.lit(1e6)
    return (
        events.groupBy(run)
        .agg(F.count("*").alias("events"), elapsed.alias("duration_seconds"))
        .withColumn(
            "events_per_second",
            F.when(F.col("duration_seconds") > 0, F.col("events") / F.col("duration_seconds")),
        )
    )


def progress_snapshot(
    ingested: DataFrame, processed: DataFrame, failed: DataFrame, started_at: Column, as_of: Column
) -> DataFrame:
    """One row: status, uptime and the event totals, counted from the tables."""
    return ingested.agg(F.count("*").alias("events_ingested_total")).select(
        F.lit("ok").alias("status"),
        started_at.alias("started_at"),
        F.greatest(
            F.lit(0).cast("long"), F.floor((F.unix_micros(as_of) - F.unix_micros(started_at)) / 1000000)
        ).alias("uptime_seconds"),
        "events_ingested_total",
        processed.agg(F.count("*")).scalar().alias("events_processed_total"),
        failed.agg(F.count("*")).scalar().alias("events_failed_total"),
    )


def parsed_snapshot(parsed: DataFrame, at: str = "timestamp") -> DataFrame:
    """`progress_snapshot` of the output of `parse_events`, from one pass; the time runs from its first to its last message."""
    accepted = F.col("reason").isNull()
    counted = parsed.agg(
        F.min(at).alias("started_at"),
        F.max(at).alias("_as_of"),
        F.count("*").alias("events_ingested_total"),
        F.count_if(accepted).alias("events_processed_total"),
        F.count_if(~accepted).alias("events_failed_total"),
    )
    elapsed = F.floor((F.unix_micros("_as_of") - F.unix_micros("started_at")) / 1000000)
    return counted.select(
        F.lit("ok").alias("status"),
        "started_at",
        F.greatest(F.lit(0).cast("long"), elapsed).alias("uptime_seconds"),
        "events_ingested_total",
        "events_processed_total",
        "events_failed_total",
    )


def acceptance_report(
    published: DataFrame,
    raw: DataFrame,
    hourly: DataFrame,
    timeseries: DataFrame,
    dead_letters: DataFrame,
    lag: DataFrame,
) -> DataFrame:
    """One row: do the stores agree, is the lag 0, are there no dead letters?"""
    counts = published.agg(F.count("*").alias("published")).select(
        "published",
        raw.agg(F.count("*")).scalar().alias("raw_rows"),
        hourly.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar().alias("hourly_count"),
        timeseries.agg(F.count("*")).scalar().alias("timeseries_rows"),
        dead_letters.agg(F.count("*")).scalar().alias("dead_letters"),
        lag.agg(F.coalesce(F.sum("lag"), F.lit(0))).scalar().alias("lag"),
    )
    agree = (
        (F.col("published") == F.col("raw_rows"))
        & (F.col("raw_rows") == F.col("hourly_count"))
        & (F.col("raw_rows") == F.col("timeseries_rows"))
    )
    return counts.withColumn("stores_agree", agree).withColumn(
        "passed", F.col("stores_agree") & (F.col("lag") == 0) & (F.col("dead_letters") == 0)
    )
