"""Merging closed batches by size class: every table reads the same at every step, and few folders are left."""

import glob

import pytest
from conftest import events, tuples, utc
from pyspark.sql import functions as F

from tidewatch.operators.rollup import hourly_partials, timeseries_rows
from tidewatch.schemas import TABLE_SCHEMAS
from tidewatch.sinks import tiers
from tidewatch.sinks.store import TableStore, archive_batches
from tidewatch.sinks.tiers import closed_spans, expire, full_class, merge_closed


def fill(spark, store, batches, stream="s"):
    for batch in batches:
        raw = events(spark, [(f"{stream}{batch}-{i}", "PushEvent", f"r/{i}", "a", utc(2026, 5, 5 + i, batch % 24)) for i in range(2)])
        store.write_batch(raw, "raw_events", stream, batch)
        store.write_batch(hourly_partials(raw), "events_hourly", stream, batch)
        store.write_batch(timeseries_rows(raw), "events_timeseries", stream, batch)
        if batch % 2:
            letter = spark.createDataFrame([("k", f"bad-{batch}", "t", 0, batch, "why", "processor")],
                                           TABLE_SCHEMAS["dead_letters"].rsplit(", stream_id", 1)[0])
            store.write_batch(letter, "dead_letters", stream, batch)
        sample = spark.createDataFrame([(utc(2026, 5, 5), "m", {"l": "x"}, float(batch))],
                                       TABLE_SCHEMAS["metric_samples"].rsplit(", stream_id", 1)[0])
        store.write_batch(sample, "metric_samples", stream, batch)
        store.mark_whole(spark, stream, batch)


def contents(spark, store, whole=False):
    found = {}
    for table in TABLE_SCHEMAS:
        rows = store.read(spark, table, whole_batches=whole).drop("batch_id", "dt")
        if table == "events_hourly":
            rows = rows.groupBy("hour", "repo_name", "event_type").agg(F.sum("count"))
        found[table] = sorted(map(str, tuples(rows)))
    return found


@pytest.fixture()
def store(spark, tmp_path):
    found = TableStore(str(tmp_path / "tables"))
    found.ensure(spark)
    return found


@pytest.mark.parametrize(
    ("spans", "fan", "expected"),
    [
        ([], 2, None),
        ([(0, 1)], 2, None),
        ([(0, 1), (1, 2), (2, 3)], 2, [(0, 1), (1, 2)]),
        ([(0, 2), (2, 3), (3, 4)], 2, [(2, 3), (3, 4)]),
        ([(0, 1), (2, 3)], 2, None),
        ([(0, 2), (2, 4), (4, 5)], 2, [(0, 2), (2, 4)]),
        ([(0, 9), (9, 10), (10, 11)], 3, None),
    ],
)
def test_the_first_full_class(spans, fan, expected):
    assert full_class(spans, fan) == expected


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_spans_grow_with_the_logarithm_of_the_batches(fan):
    spans = []
    for batch in range(1000):
        spans.append((batch, batch + 1))
        while some := full_class(spans, fan):
            spans = sorted([s for s in spans if s not in some] + [(some[0][0], some[-1][1])])
    classes = 1
    while fan**classes <= 1000:
        classes += 1
    assert len(spans) <= (fan - 1) * classes
    assert spans[0][0] == 0 and spans[-1][1] == 1000 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_all_tables_read_the_same_and_replaced_folders_go(spark, store, tmp_path):
    fill(spark, store, range(7))
    fill(spark, store, range(1), stream="other")
    before = contents(spark, store)
    made = merge_closed(spark, store, "s", 6, str(tmp_path / "merged"), fan=2)
    assert [(a.first_batch, a.end_batch) for a in made] == [(0, 1 + 1), (2, 4), (4, 6), (0, 4)]
    assert contents(spark, store) == contents(spark, store, whole=True) == before
    assert closed_spans(spark, store, "s", 6) == [(0, 4), (4, 6)]
    assert expire(spark, store, "s") > 0
    assert contents(spark, store) == contents(spark, store, whole=True) == before
    assert store.stored_batches(spark, "raw_events") == [("other", 0), ("s", 6)]
    assert sorted(glob.glob(str(tmp_path / "merged" / "s" / "*"))) == [str(tmp_path / "merged" / "s" / n) for n in ("0-4", "4-6")]
    assert expire(spark, store, "s") == 0
    fill(spark, store, range(7, 9))
    now = contents(spark, store)
    merge_closed(spark, store, "s", 8, str(tmp_path / "merged"), fan=2)
    expire(spark, store, "s")
    assert closed_spans(spark, store, "s", 8) == [(0, 8)]
    assert contents(spark, store) == now


@pytest.mark.parametrize("stop", ["metric_samples", "listing"])
def test_a_merge_that_stops_changes_nothing_and_is_done_again(spark, store, tmp_path, monkeypatch, stop):
    fill(spark, store, range(3))
    before, write = contents(spark, store), tiers.write_for_reading

    def broken(rows, table, path):
        if table == stop:
            raise OSError("gone")
        write(rows, table, path)

    with monkeypatch.context() as patched:
        patched.setattr(tiers, "write_for_reading", broken)
        if stop == "listing":
            patched.setattr(tiers, "list_archive", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            merge_closed(spark, store, "s", 2, str(tmp_path / "merged"), fan=2)
    assert contents(spark, store) == before and expire(spark, store, "s") == 0
    assert len(merge_closed(spark, store, "s", 2, str(tmp_path / "merged"), fan=2)) == 1
    expire(spark, store, "s")
    assert contents(spark, store) == before


def test_plain_archives_are_merged_further(spark, store, tmp_path):
    fill(spark, store, range(5))
    before = contents(spark, store)
    archive_batches(spark, store, "s", 2, str(tmp_path / "plain"))
    merge_closed(spark, store, "s", 4, str(tmp_path / "merged"), fan=2)
    expire(spark, store, "s")
    assert closed_spans(spark, store, "s", 4) == [(0, 4)] and contents(spark, store) == before
    assert glob.glob(str(tmp_path / "plain" / "*")) == []


def test_known_ids_stay_known(spark, store, tmp_path):
    fill(spark, store, range(3))
    assert len(store.complete_ids(spark)) == 3
    merge_closed(spark, store, "s", 2, str(tmp_path / "merged"), fan=2)
    expire(spark, store, "s")
    assert store.complete_ids(spark) == []
    asked = spark.createDataFrame([("s0-0",), ("s1-1",), ("new",)], "id string")
    assert {"s0-0", "s1-1"} <= {row.id for row in store.ids.candidates(asked).collect()}


def test_a_batch_is_added_to_the_catalog_alone(spark, store):
    fill(spark, store, range(1))
    try:
        store.ensure_catalog(spark, "tiers_test")
        fill(spark, store, range(1, 4))
        store.add_to_catalog(spark, "tiers_test", "s", 1)
        store.add_to_catalog(spark, "tiers_test", "s", 1)
        for table in TABLE_SCHEMAS:
            found = spark.sql(f"SELECT DISTINCT batch_id FROM tiers_test.{table} ORDER BY 1")
            assert tuples(found) == ([(1,)] if table == "dead_letters" else [(0,), (1,)])
    finally:
        spark.sql("DROP DATABASE IF EXISTS tiers_test CASCADE")
