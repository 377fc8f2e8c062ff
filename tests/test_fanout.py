import glob
import os
import random
import shutil
import time
from datetime import timedelta

import pytest
from conftest import messages, raw_json, tuples, utc
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewatch.functions.contract import parse_events, valid_events
from tidewatch.operators.activity import event_breakdown, trending_repos
from tidewatch.operators.events import keep_first
from tidewatch.operators.rollup import hourly_partials
from tidewatch.sinks.publish import start_publishing
from tidewatch.sinks.store import TableStore, archive_batches
from tidewatch.sources.topic import stream_topic_files
from tidewatch.streaming import fanout
from tidewatch.streaming.fanout import FanOut, replay_dead_letters, start_fan_out
from tidewatch.streaming.monitor import JobMetrics

NO_WAIT = {"delays": (), "sleep": lambda seconds: None}


@pytest.fixture()
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("topic", "tables", "checkpoint")}


def land(spark, place, values, **position):
    messages(spark, values, **position).coalesce(1).write.mode("append").parquet(place["topic"])


def run(spark, place, job=None, max_files=None, checkpoint="checkpoint"):
    job = job or FanOut(TableStore(place["tables"]), "s1", **NO_WAIT)
    stream = stream_topic_files(spark, place["topic"], max_files)
    start_fan_out(stream, job, place.get(checkpoint, checkpoint), available_now=True).awaitTermination()
    return job.store


def contents(spark, store):
    hourly = store.read(spark, "events_hourly").groupBy("repo_name", "event_type").agg(F.sum("count"))
    return {
        "raw": sorted(tuples(store.read(spark, "raw_events").select("id", "type", "repo_name", "created_at", "payload"))),
        "hourly": sorted(tuples(hourly)),
        "timeseries": sorted(tuples(store.read(spark, "events_timeseries").select("timestamp", "event_type", "repo_name"))),
        "dead": sorted(tuples(store.read(spark, "dead_letters").select("key", "value", "offset", "reason", "stage"))),
    }


def test_two_messages_and_a_malformed_one(spark, place):
    first = raw_json("offset-1", "PushEvent", "team/offset", "dev", "2026-05-08T15:00:00Z")
    second = raw_json("offset-2", "IssuesEvent", "team/offset", "dev", "2026-05-08T15:05:00Z")
    land(spark, place, [first, second])
    found = contents(spark, run(spark, place))
    assert [(row[0], row[1]) for row in found["raw"]] == [("offset-1", "PushEvent"), ("offset-2", "IssuesEvent")]
    assert found["hourly"] == [("team/offset", "IssuesEvent", 1), ("team/offset", "PushEvent", 1)]
    assert len(found["timeseries"]) == 2 and found["dead"] == []

    land(spark, place, ['{"id":'], start=2)
    again = contents(spark, run(spark, place))
    assert again["dead"] == [("k", '{"id":', 2, "invalid json", "decode")]
    assert {**again, "dead": []} == found


def test_any_type_on_the_topic_is_stored(spark, place):
    land(spark, place, [raw_json("1", "CreateEvent")])
    assert len(contents(spark, run(spark, place))["raw"]) == 1


def test_first_writer_wins_within_and_across_batches(spark, place):
    land(spark, place, [raw_json("1", "PushEvent"), raw_json("1", "IssuesEvent")])
    run(spark, place)
    land(spark, place, [raw_json("1", "ForkEvent"), raw_json("2", "ForkEvent")], start=2)
    found = contents(spark, run(spark, place))
    assert [(row[0], row[1]) for row in found["raw"]] == [("1", "PushEvent"), ("2", "ForkEvent")]
    assert [row[2] for row in found["hourly"]] == [1, 1]


def shuffled_topic(spark, place, seed=7, files=4):
    """Late, duplicated, shuffled events and some damaged ones, over several files."""
    rng = random.Random(seed)
    start = utc(2026, 5, 1)
    values = []
    for n in range(60):
        at = (start + timedelta(minutes=rng.randrange(0, 5000))).strftime("%Y-%m-%dT%H:%M:%SZ")
        values.append(raw_json(f"e{n:03d}", rng.choice(["PushEvent", "ForkEvent"]), rng.choice(["a/hot", "b/b", "c/c"]), "x", at))
    values += rng.choices(values, k=40) + ["{", '{"id":"x"}']
    rng.shuffle(values)
    for n in range(files):
        land(spark, place, values[n::files], partition=n)
    return values


@pytest.mark.parametrize("broadcast_bytes", [fanout.BROADCAST_ID_BYTES, 0])
@pytest.mark.parametrize("same_day", [False, True])
def test_stream_equals_batch_for_shuffled_late_duplicates(spark, place, monkeypatch, broadcast_bytes, same_day):
    monkeypatch.setattr(fanout, "BROADCAST_ID_BYTES", broadcast_bytes)
    values = shuffled_topic(spark, place)
    job = FanOut(TableStore(place["tables"]), "s1", same_day_ids=same_day, **NO_WAIT)
    found = contents(spark, run(spark, place, job, max_files=1))
    events = keep_first(valid_events(parse_events(messages(spark, values))), ["offset"])
    assert [row[0] for row in found["raw"]] == sorted(row.id for row in events.collect())
    want = hourly_partials(events).groupBy("repo_name", "event_type").agg(F.sum("count"))
    assert found["hourly"] == sorted(tuples(want))
    assert len(found["timeseries"]) == len(found["raw"]) == 60
    assert len(found["dead"]) == 2


def test_replay_of_an_uncommitted_batch_changes_nothing(spark, place):
    shuffled_topic(spark, place)
    store = run(spark, place, max_files=1)
    before = contents(spark, store)
    commits = sorted(glob.glob(f"{place['checkpoint']}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(commits[-1])
    crc = f"{place['checkpoint']}/commits/.{os.path.basename(commits[-1])}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert contents(spark, run(spark, place, max_files=1)) == before


def test_a_second_stream_over_the_same_files_stores_nothing_new(spark, place, tmp_path):
    shuffled_topic(spark, place)
    store = run(spark, place, max_files=1)
    before = contents(spark, store)
    other = FanOut(store, "s2", **NO_WAIT)
    after = contents(spark, run(spark, place, other, max_files=2, checkpoint=str(tmp_path / "other")))
    assert {**after, "dead": before["dead"]} == before
    assert len(after["dead"]) == 2 * len(before["dead"])


class Broken(FanOut):
    """Fails writes to the tables in `broken`, as often as given."""

    broken: dict

    def _write(self, rows, table, batch_id, *options):
        if self.broken.get(table, 0) > 0:
            self.broken[table] -= 1
            raise OSError(f"{table} is down")
        super()._write(rows, table, batch_id, *options)


def broken(place, tables, delays=()):
    job = Broken(TableStore(place["tables"]), "s1", delays=delays, sleep=lambda seconds: None)
    job.broken = dict(tables)
    return job


def test_failed_dead_letters_after_exhaustion_leave_no_rows_and_a_restart_stores_all(spark, place):
    shuffled_topic(spark, place)
    job = broken(place, {"events_hourly": 1})
    original = job._write

    def dead_letters_down(rows, table, batch_id, *options):
        if table == "dead_letters" and job.broken["events_hourly"] == 0:
            raise OSError("dead letters are down")
        original(rows, table, batch_id, *options)

    job._write = dead_letters_down
    with pytest.raises(StreamingQueryException):
        run(spark, place, job)
    half = contents(spark, job.store)
    assert half["raw"] == half["hourly"] == []
    found = contents(spark, run(spark, place))
    assert len(found["raw"]) == 60 and sum(row[2] for row in found["hourly"]) == 60


def test_raw_failure_skips_analytics_and_dead_letters_the_batch(spark, place):
    good, bad = raw_json("1"), "{"
    land(spark, place, [good, bad])
    job = broken(place, {"raw_events": 99}, delays=(0.1, 0.5, 2.0))
    waits = []
    job.sleep = waits.append
    passed_on = []
    job.on_dead_letters = lambda rows, batch_id: passed_on.extend(tuples(rows.select("key", "value")))
    found = contents(spark, run(spark, place, job))
    assert waits == [0.1, 0.5, 2.0]
    assert found["raw"] == found["hourly"] == found["timeseries"] == []
    assert [(row[1], row[4]) for row in found["dead"]] == [(bad, "decode"), (good, "write")]
    assert passed_on == [("k", bad), ("k", good)]
    assert job.metrics.counters[("events_failed_total", "")] == 2
    assert job.metrics.counters[("processor_retries_total", "")] == 3
    # Progress moved on: nothing is left to do.
    assert contents(spark, run(spark, place)) == found


def test_a_retry_that_succeeds_leaves_one_copy(spark, place):
    land(spark, place, [raw_json("1"), raw_json("2")])
    found = contents(spark, run(spark, place, broken(place, {"events_timeseries": 2}, delays=(0, 0, 0))))
    assert len(found["raw"]) == len(found["timeseries"]) == 2
    assert sum(row[2] for row in found["hourly"]) == 2


def test_failing_dead_letters_hold_the_progress(spark, place):
    land(spark, place, ["{"])
    with pytest.raises(StreamingQueryException):
        run(spark, place, broken(place, {"dead_letters": 1}))
    assert len(contents(spark, run(spark, place))["dead"]) == 1


def test_batch_metrics_are_stored(spark, place):
    land(spark, place, [raw_json("1"), raw_json("2"), "{"])
    store = run(spark, place)
    values = {(row.metric, row.labels.get("le")): row.value for row in store.read(spark, "metric_samples").collect()}
    assert values[("events_processed_total", None)] == 2
    assert values[("events_failed_total", None)] == values[("dlq_depth", None)] == 1
    assert values[("raw_write_duration_seconds_bucket", "+Inf")] == 1


def test_streams_of_one_session_keep_their_samples_apart(spark, place, tmp_path):
    land(spark, place, [raw_json("1"), raw_json("2")])
    jobs = {name: FanOut(TableStore(str(tmp_path / name)), name, **NO_WAIT) for name in ("one", "two")}
    run(spark, place, jobs["one"], checkpoint=str(tmp_path / "c1"))
    land(spark, place, [raw_json("3")], start=2)
    ingest = JobMetrics()
    records = stream_topic_files(spark, place["topic"]).select("key", "value")
    store = TableStore(str(tmp_path / "ingest"))
    queries = [
        start_fan_out(stream_topic_files(spark, place["topic"]), jobs["two"], str(tmp_path / "c2"), available_now=True),
        start_publishing(records, str(tmp_path / "c3"), path=str(tmp_path / "out"), available_now=True, metrics=ingest, store=store),
    ]
    for query in queries:
        query.awaitTermination()
    wanted = {"one": 2, "two": 3, "ingest": 3}

    def counted():
        found = {name: job.metrics.counters.get(("input_rows_total", "")) for name, job in jobs.items()}
        return found | {"ingest": ingest.counters.get(("input_rows_total", ""))}

    deadline = time.time() + 20
    while counted() != wanted and time.time() < deadline:
        time.sleep(0.1)
    assert counted() == wanted
    assert jobs["one"].metrics.counters[("batch_duration_seconds_count", "")] >= 1
    samples = store.read(spark, "metric_samples").filter("metric = 'input_rows_total'")
    while not samples.count() and time.time() < deadline:
        time.sleep(0.1)
        samples = store.read(spark, "metric_samples").filter("metric = 'input_rows_total'")
    assert [(row.stream_id, row.value) for row in samples.collect()][-1] == ("ingest", 3.0)


def test_queries_on_stored_tables(spark, place):
    rows = [("1", "PushEvent", "top/r"), ("2", "PushEvent", "top/r"), ("3", "IssuesEvent", "next/r")]
    land(spark, place, [raw_json(i, t, r, "x", "2026-05-08T15:00:00Z") for i, t, r in rows])
    hourly = run(spark, place).read(spark, "events_hourly")
    as_of = utc(2026, 5, 8, 16)
    assert tuples(trending_repos(hourly, as_of, 24, 10)) == [("top/r", 2), ("next/r", 1)]
    assert tuples(event_breakdown(hourly, as_of, 24)) == [("PushEvent", 2), ("IssuesEvent", 1)]


def test_ensure_is_repeatable_and_keeps_rows(spark, place):
    store = TableStore(place["tables"])
    store.ensure(spark)
    assert store.read(spark, "raw_events").count() == 0
    store.write_batch(spark.createDataFrame([("1", "T", "r", "a", utc(2026, 5, 8), "{}")], "id string, type string, repo_name string, actor_name string, created_at timestamp, payload string"), "raw_events", "s", 0)
    store.ensure(spark)
    assert store.read(spark, "raw_events").count() == 1
    with pytest.raises(ValueError, match="invalid stream_id"):
        FanOut(store, "../x")
    with pytest.raises(ValueError, match="unknown table"):
        store.path("other")


def test_archived_batches_read_the_same_and_still_block_their_ids(spark, place, tmp_path):
    shuffled_topic(spark, place)
    store = run(spark, place, max_files=1)
    before = contents(spark, store)
    with pytest.raises(ValueError, match="no closed batches"):
        archive_batches(spark, store, "s1", 0, str(tmp_path / "none"))
    once = archive_batches(spark, store, "s1", 2, str(tmp_path / "v1"))
    twice = archive_batches(spark, once, "s1", 3, str(tmp_path / "v2"))
    assert [(a.first_batch, a.end_batch) for a in twice.archives] == [(0, 2), (2, 3)]
    assert contents(spark, once) == contents(spark, twice) == before
    compacted = spark.read.parquet(str(tmp_path / "v1" / "events_hourly"))
    assert compacted.count() == compacted.select("hour", "repo_name", "event_type").distinct().count()

    # The live copies of archived batches are not needed any more.
    shutil.rmtree(f"{place['tables']}/raw_events/stream_id=s1/batch_id=0")
    assert contents(spark, twice) == before
    values = [row[4] for row in before["raw"]]
    land(spark, place, [*values, raw_json("new")], partition=9)
    after = contents(spark, run(spark, place, FanOut(twice, "s1", **NO_WAIT)))
    assert [row[0] for row in after["raw"]] == [*[row[0] for row in before["raw"]], "new"]


def test_tables_by_name_in_a_catalog(spark, place):
    land(spark, place, [raw_json("1")])
    store = run(spark, place)
    try:
        store.ensure_catalog(spark, "activity_test")
        store.ensure_catalog(spark, "activity_test")
        assert tuples(spark.sql("SELECT id, repo_name FROM activity_test.raw_events")) == [("1", "tide/pool")]
        land(spark, place, [raw_json("2")], start=1)
        run(spark, place)
        store.refresh_catalog(spark, "activity_test")
        assert spark.table("activity_test.raw_events").count() == spark.table("activity_test.events_timeseries").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS activity_test CASCADE")


@pytest.mark.parametrize("table", ["events_hourly", "events_timeseries"])
def test_exhausted_batches_leave_tables_equal_and_replay(spark, place, table):
    land(spark, place, [raw_json("1"), raw_json("2")])
    found = contents(spark, run(spark, place, broken(place, {table: 99})))
    assert found["raw"] == found["hourly"] == found["timeseries"] == []
    reasons = {row.reason for row in broken(place, {}).store.read(spark, "dead_letters").collect()}
    assert len(reasons) == 1 and "OSError" in reasons.pop()
    job = FanOut(broken(place, {}).store, "replay-1", record_samples=False)
    for _ in range(2):
        replay_dead_letters(spark, job, broken(place, {}).stream_id)
        found = contents(spark, job.store)
        assert len(found["raw"]) == len(found["timeseries"]) == 2
        assert sum(row[2] for row in found["hourly"]) == 2


def test_a_new_store_reads_archives_after_their_batches_are_gone(spark, place):
    store = None
    for i in range(3):
        land(spark, place, [raw_json(f"a{i}")])
        store = run(spark, place)
    stream = broken(place, {}).stream_id
    before = contents(spark, store)
    archive_batches(spark, store, stream, 2, place["tables"] + "-archive")
    for batch in (0, 1):
        for name in ("raw_events", "events_hourly", "events_timeseries"):
            store.clear_batch(spark, name, stream, batch)
    again = contents(spark, TableStore(store.root))
    assert len(again["raw"]) == len(before["raw"]) == 3 and again["hourly"] == before["hourly"]
