import random

import pytest
from conftest import events, tuples, utc
from pyspark.sql import functions as F

from tidewatch.operators import audit
from tidewatch.operators.rollup import hourly_partials, timeseries_rows

AT = utc(2026, 5, 5, 10)


def offsets(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, done boolean")


def contiguous(frame):
    return {(row.topic, row.partition): row.contiguous_offset for row in audit.contiguous_offsets(frame, "done").collect()}


def test_offsets_wait_for_the_first(spark):
    for done, want in (({12}, None), ({10, 12}, 10), ({10, 11, 12}, 12)):
        frame = offsets(spark, [("t", 0, o, o in done) for o in (10, 11, 12)])
        assert contiguous(frame) == {("t", 0): want}


def test_partitions_are_independent(spark):
    frame = offsets(spark, [("t", 0, 5, False), ("t", 1, 20, True)])
    assert contiguous(frame) == {("t", 0): None, ("t", 1): 20}


def test_a_missing_offset_is_a_gap(spark):
    assert contiguous(offsets(spark, [("t", 0, o, True) for o in (10, 11, 13)])) == {("t", 0): 11}


SPAN = audit.BITMAP_SPAN


@pytest.mark.parametrize(
    "start,end,gap",
    [
        (0, 3 * SPAN, None),
        (0, 3 * SPAN, SPAN - 1),
        (0, 3 * SPAN, SPAN),
        (5, 2 * SPAN + 7, 2 * SPAN + 3),
        (SPAN - 1, SPAN + 1, None),
        (SPAN - 1, SPAN + 1, SPAN),
        (0, SPAN, None),
        (0, 2 * SPAN, 0),
    ],
)
def test_offsets_across_bitmap_edges_with_repeats(spark, start, end, gap):
    done = F.lit(True) if gap is None else F.col("offset") != gap
    frame = spark.range(start, end).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), done.alias("done")
    )
    want = end - 1 if gap is None else (gap - 1 if gap > start else None)
    assert contiguous(frame.unionByName(frame)) == {("t", 0): want}


def test_random_offsets_match_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for partition in range(8):
        first = rng.randrange(0, 3 * SPAN)
        rows += [("t", partition, first + i, rng.random() < 0.98) for i in range(rng.randrange(1, 200))]
    want = {}
    for topic, partition, offset, done in rows:
        state = want.setdefault((topic, partition), [None, False])
        if done and not state[1]:
            state[0] = offset
        else:
            state[1] = True
    rng.shuffle(rows)
    assert contiguous(offsets(spark, rows)) == {key: state[0] for key, state in want.items()}


def test_lag_counts_from_the_last_contiguous_offset(spark):
    rows = [("t", 0, o, o != 12) for o in (10, 11, 12, 13)] + [("t", 1, 7, False), ("t", 1, 8, True)]
    lag = {row.partition: row.lag for row in audit.topic_lag(offsets(spark, rows), "done").collect()}
    assert lag == {0: 2, 1: 2}


def test_duplicates_and_summary(spark):
    raw = events(spark, [("1", "PushEvent", "r", "a", AT), ("1", "PushEvent", "r", "a", AT), ("2", "ForkEvent", "r", "a", AT)])
    assert tuples(audit.duplicate_ids(raw)) == [("1", 2)]
    assert tuples(audit.id_summary(raw, "1")) == [(2, "PushEvent")]


def test_totals(spark):
    raw = events(spark, [("run-1", "P", "run/r", "a", AT), ("run-2", "P", "run/r", "a", AT), ("x", "P", "running/r", "a", AT)])
    hourly = hourly_partials(raw)
    assert tuples(audit.repo_totals(hourly, timeseries_rows(raw), "run/r")) == [("run/r", 2, 2)]
    assert tuples(audit.repo_totals(hourly, timeseries_rows(raw), "none")) == [("none", 0, 0)]
    assert tuples(audit.prefix_totals(raw, hourly, "run")) == [(2, 2)]


def test_reconcile_shows_missing_and_surplus(spark):
    published = events(spark, [("1", "P", "a", "x", AT), ("2", "P", "b", "x", AT)])
    raw = published.filter("id = '1'")
    hourly = hourly_partials(published.unionByName(published))
    rows = {row.repo_name: (row.published, row.raw_rows, row.hourly_count, row.raw_diff, row.hourly_diff) for row in audit.reconcile_stores(published, raw, hourly).collect()}
    assert rows == {"a": (1, 1, 2, 0, 1), "b": (1, 0, 2, 1, 2)}


def test_snapshot(spark):
    frame = spark.range(3)
    row = audit.progress_snapshot(
        frame, spark.range(2), spark.range(1), F.lit(utc(2026, 5, 5, 20)), F.lit(utc(2026, 5, 5, 20, 0, 10))
    ).first()
    assert (row.status, row.uptime_seconds) == ("ok", 10)
    assert (row.events_ingested_total, row.events_processed_total, row.events_failed_total) == (3, 2, 1)
    early = audit.progress_snapshot(frame, frame, frame, F.lit(AT), F.lit(utc(2026, 5, 4)))
    assert early.first().uptime_seconds == 0


def test_snapshot_of_parsed_messages(spark):
    rows = [(AT, None), (utc(2026, 5, 5, 10, 0, 7), "invalid json"), (utc(2026, 5, 5, 10, 0, 3), None)]
    row = audit.parsed_snapshot(spark.createDataFrame(rows, "timestamp timestamp, reason string")).first()
    assert (row.status, row.uptime_seconds) == ("ok", 7)
    assert (row.events_ingested_total, row.events_processed_total, row.events_failed_total) == (3, 2, 1)
    none = audit.parsed_snapshot(spark.createDataFrame([], "timestamp timestamp, reason string")).first()
    assert (none.uptime_seconds, none.events_ingested_total, none.events_failed_total) == (0, 0, 0)


@pytest.mark.parametrize("missing", [None, 0, 5, 32767, 32768, 40000, 65535, 65536, 70000])
def test_offsets_over_many_spans(spark, missing):
    # Whole spans are missing after 98303, and offset `missing` isn't done.
    frame = spark.range(3, 98304).union(spark.range(200000, 200010)).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    frame = frame.withColumn("done", F.lit(True) if missing is None else F.col("offset") != missing)
    want = 98303 if missing in (None, 0) else missing - 1
    assert contiguous(frame) == {("t", 0): want}
    lost = frame if missing is None else frame.where("done")
    assert contiguous(lost) == {("t", 0): want}
    assert [(r.latest_offset, r.lag) for r in audit.topic_lag(frame, "done").collect()] == [(200009, 200009 - want)]


def test_load_summary(spark):
    raw = events(spark, [("1", "P", "r", "a", AT), ("2", "P", "r", "a", utc(2026, 5, 5, 10, 0, 4))])
    assert tuples(audit.load_summary(raw, "repo_name")) == [("r", 2, 4.0, 0.5)]


def test_acceptance(spark):
    raw = events(spark, [("1", "P", "r", "a", AT)])
    none = spark.createDataFrame([], "value string")
    lag = audit.topic_lag(offsets(spark, [("t", 0, 0, True)]), "done")
    row = audit.acceptance_report(raw, raw, hourly_partials(raw), timeseries_rows(raw), none, lag).first()
    assert row.passed and row.lag == 0
    behind = audit.topic_lag(offsets(spark, [("t", 0, 0, False)]), "done")
    assert not audit.acceptance_report(raw, raw, hourly_partials(raw), timeseries_rows(raw), none, behind).first().passed
