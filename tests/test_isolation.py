"""Messages that make a batch's writes fail are found by halving; all others are stored."""

import pytest
from conftest import messages, raw_json, tuples
from pyspark.sql import functions as F

from tidewatch.sinks.store import TableStore
from tidewatch.streaming.fanout import FanOut, OffsetRange, halves, replay_dead_letters


class Poisoned(FanOut):
    """Raw writes fail while they hold one of the ids in `poison`, wherever Spark evaluates them."""

    poison: tuple = ()

    def _write(self, rows, table, batch_id):
        if table == "raw_events" and self.poison:
            bad = F.col("id").isin(*self.poison)
            rows = rows.withColumn("payload", F.when(bad, F.raise_error(F.lit("poison"))).otherwise(F.col("payload")))
        super()._write(rows, table, batch_id)


def poisoned(root, poison, stream="s1", attempts=64):
    job = Poisoned(TableStore(root), stream, delays=(), record_samples=False, isolate_attempts=attempts)
    job.poison = poison
    return job


def topic(spark, count):
    ids = spark.range(count).select(F.col("id").cast("string").alias("n"))
    value = F.concat(F.lit('{"id":"'), "n", F.lit('","type":"PushEvent","repo":{"name":"tide/pool"},"actor":{"login":"heron"},"created_at":"2026-03-09T17:28:39Z"}'))
    return ids.select(
        F.lit("k").alias("key"), value.alias("value"), F.lit("t").alias("topic"), (F.col("n").cast("int") % 3).alias("partition"),
        (F.col("n").cast("long") / 3).cast("long").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
    )


def test_one_bad_row_in_ten_thousand(spark, tmp_path):
    job = poisoned(str(tmp_path), ("7003",))
    job.store.ensure(spark)
    passed_on = []
    job.on_dead_letters = lambda rows, batch_id: passed_on.extend(r.value for r in rows.collect())
    job.process(topic(spark, 10_000), 0)
    raw = job.store.read(spark, "raw_events")
    assert raw.count() == raw.select("id").distinct().count() == 9_999 and raw.where("id = '7003'").count() == 0
    letters = job.store.read(spark, "dead_letters").collect()
    assert len(letters) == 1 == len(passed_on) and '"7003"' in letters[0].value and "poison" in letters[0].reason and letters[0].stage == "write"
    assert job.store.read(spark, "events_hourly").agg(F.sum("count")).first()[0] == 9_999
    assert job.metrics.counters[("events_failed_total", "")] == 1 and job.metrics.counters[("events_processed_total", "")] == 9_999
    assert job.metrics.counters[("isolation_attempts_total", "")] <= 30
    # Mended and replayed: as if nothing had failed, and again.
    for _ in range(2):
        replay_dead_letters(spark, poisoned(str(tmp_path), (), "replay"), "s1")
        assert job.store.read(spark, "raw_events").count() == job.store.read(spark, "events_timeseries").count() == 10_000


def test_several_bad_rows_and_a_copy_of_one(spark, tmp_path):
    job = poisoned(str(tmp_path), ("2", "5"))
    job.store.ensure(spark)
    values = [raw_json(v) for v in "123456781"] + ["{"]
    for _ in range(2):  # a batch that runs again leaves the same tables
        job.process(messages(spark, values), 0)
        assert sorted(r.id for r in job.store.read(spark, "raw_events").collect()) == list("134678")
        letters = tuples(job.store.read(spark, "dead_letters").select("offset", "stage").orderBy("offset"))
        assert letters == [(1, "write"), (4, "write"), (9, "decode")]


def test_attempts_are_bounded(spark, tmp_path):
    job = poisoned(str(tmp_path), tuple("12345678"), attempts=3)
    job.store.ensure(spark)
    job.process(messages(spark, [raw_json(v) for v in "12345678"] + [raw_json("a"), raw_json("b")]), 0)
    assert job.metrics.counters[("isolation_attempts_total", "")] <= 3
    stored = {r.id for r in job.store.read(spark, "raw_events").collect()}
    letters = job.store.read(spark, "dead_letters").count()
    assert stored <= {"a", "b"} and letters == 10 - len(stored)


def test_a_store_that_is_down_is_no_poison(spark, tmp_path):
    job = poisoned(str(tmp_path), ())
    job.store.ensure(spark)
    job._store_batch = lambda *some: (_ for _ in ()).throw(OSError("down"))
    job.process(messages(spark, [raw_json("1"), raw_json("2")]), 0)
    assert job.store.read(spark, "dead_letters").count() == 2 and job.store.read(spark, "raw_events").count() == 0
    assert ("isolation_attempts_total", "") not in job.metrics.counters


@pytest.mark.parametrize("ranges", [[(0, 9)], [(0, 0), (5, 5)], [(0, 2), (3, 3), (10, 99)], [(4, 4)]])
def test_halves_cover_the_ranges_once(ranges):
    given = [OffsetRange("t", p, a, b) for p, (a, b) in enumerate(ranges)]

    def offsets(parts):
        return [(r.partition, o) for r in parts for o in range(r.low, r.high + 1)]

    found = halves(given)
    if len(offsets(given)) == 1:
        assert found == []
    else:
        assert sorted(offsets(found[0]) + offsets(found[1])) == offsets(given)
        assert abs(len(offsets(found[0])) - len(offsets(found[1]))) <= 1
