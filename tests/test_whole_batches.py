"""Reads of whole batches after a crash between any two writes, and while a batch is written again."""

import pytest
from conftest import messages, raw_json
from pyspark.sql import functions as F

from tidewatch.sinks.store import TableStore, archive_batches
from tidewatch.streaming.fanout import FanOut

TABLES = ("raw_events", "events_hourly", "events_timeseries")


class Crash(BaseException):
    """Ends a batch at once, as a lost driver does."""


class Crashing(FanOut):
    left: int

    def _write(self, rows, table, batch_id):
        if self.left == 0:
            raise Crash
        self.left -= 1
        super()._write(rows, table, batch_id)


def counts(spark, store):
    raw, hourly, series = (store.read(spark, table, whole_batches=True) for table in TABLES)
    return raw.count(), hourly.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0], series.count()


@pytest.mark.parametrize("writes", range(5))
def test_a_crash_between_two_writes_shows_in_no_table(spark, tmp_path, writes):
    store = TableStore(str(tmp_path))
    store.ensure(spark)
    assert counts(spark, store) == (0, 0, 0) and store.read(spark, "dead_letters", whole_batches=True).count() == 0
    FanOut(store, "s1", delays=()).process(messages(spark, [raw_json("1"), raw_json("2")]), 0)
    assert counts(spark, store) == (2, 2, 2)
    job = Crashing(store, "s1", delays=())
    job.left = writes
    again = messages(spark, [raw_json("2"), raw_json("3"), "{"], start=2)
    with pytest.raises(Crash):
        job.process(again, 1)
    assert counts(spark, store) == (2, 2, 2) and store.read(spark, "dead_letters", whole_batches=True).count() == 0
    FanOut(store, "s1", delays=()).process(again, 1)
    assert counts(spark, store) == (3, 3, 3) and store.read(spark, "dead_letters", whole_batches=True).count() == 1
    # The same batch once more, crashing: it is hidden until it is whole again.
    job.left = writes
    with pytest.raises(Crash):
        job.process(again, 1)
    assert counts(spark, store) == (2, 2, 2)


def test_archived_batches_are_whole(spark, tmp_path):
    store = TableStore(str(tmp_path / "tables"))
    store.ensure(spark)
    job = FanOut(store, "s1", delays=())
    for i in range(3):
        job.process(messages(spark, [raw_json(str(i))], start=i), i)
    archived = archive_batches(spark, store, "s1", 2, str(tmp_path / "archive"))
    for batch in (0, 1):
        for table in TABLES:
            store.clear_batch(spark, table, "s1", batch)
    assert counts(spark, archived) == counts(spark, TableStore(store.root)) == (3, 3, 3)
