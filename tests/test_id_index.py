"""Known ids by run and bucket: the same answers as a scan, from few files, whatever was merged or replayed."""

import random
import re

import numpy as np
import pytest
from conftest import messages, raw_json
from pyspark.sql import functions as F

from tidewatch.sinks import id_index
from tidewatch.sinks.id_index import IdIndex, covered, run_name
from tidewatch.sinks.store import TableStore
from tidewatch.streaming.fanout import FanOut


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def many_runs(spark, index, runs, size, seed=1):
    """Runs of ids in random order, written in one job in the index's own layout; returns all ids."""
    dice = random.Random(seed)
    known = [f"{dice.getrandbits(60)}" for _ in range(runs * size)]
    rows = spark.createDataFrame([(v, run_name("s", i // size)) for i, v in enumerate(known)], "id string, run string")
    rows.withColumn("file", F.lit(0)).repartition(8, "run").sortWithinPartitions("run", "id").write.partitionBy("run", "file").parquet(index.ids_path())
    hashed = rows.select("run", F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), F.lit(0).alias("part"), F.lit(1).alias("parts"), F.lit(1).alias("files"))

    def filters(group):
        row = id_index._row_filter(group)
        row["run"] = group["run"].iloc[0]
        return row

    made = hashed.groupBy("run").applyInPandas(filters, id_index.FILTER_SCHEMA)
    made.repartition(8, "run").write.partitionBy("run").parquet(index.filters_path())
    return known


def opened(frame):
    return {re.search(r"run=([^/]+)/file=(\d+)", f).groups() for f in frame.inputFiles()}


def test_a_batch_opens_few_files_however_many_runs_there_are(spark, tmp_path):
    fresh = [f"new-{i}" for i in range(200)]
    files = {}
    for runs in (10, 1000):
        index = IdIndex(str(tmp_path / str(runs)))
        known = many_runs(spark, index, runs, 50)
        assert len(index.runs(spark)) == runs
        found = index.candidates(ids(spark, fresh))
        files[runs] = len(opened(found))
        assert found.join(ids(spark, fresh), "id").count() == 0
        some = known[7::97][:5]
        found = index.candidates(ids(spark, [*fresh, *some]))
        assert sorted(r.id for r in found.join(ids(spark, [*fresh, *some]), "id").collect()) == sorted(some)
        assert len(opened(found)) <= len(some) + 3
        # A batch does not meet its own earlier try.
        mine = run_name("s", 7 // 50)
        again = index.candidates(ids(spark, [known[7]]), skip=mine)
        assert all(run != mine for run, _ in opened(again))
    assert files[10] <= 3 and files[1000] <= 3


def test_answers_equal_a_set_for_random_batches(spark, tmp_path):
    dice = random.Random(3)
    index, stored = IdIndex(str(tmp_path)), set()
    assert index.runs(spark) == [] and index.candidates(ids(spark, ["a"])).count() == 0
    for batch in range(5):
        values = {str(dice.randrange(400)) for _ in range(80)}
        for _ in range(2):  # as a batch that runs again would
            probe = ids(spark, values)
            found = {r.id for r in index.candidates(probe, run_name("s", batch)).join(probe, "id").collect()}
            assert found == values & stored
            index.write(ids(spark, values - found), run_name("s", batch))
        stored |= values
    assert index.candidates(ids(spark, [])).count() == 0
    index.remove(spark, run_name("s", 4))
    assert run_name("s", 4) not in index.runs(spark)


def test_large_buckets_have_several_filter_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "ROW_IDS", 16)
    monkeypatch.setattr(id_index, "PROBE_IDS", 2)
    monkeypatch.setattr(id_index, "FILE_IDS", 800)
    index = IdIndex(str(tmp_path))
    index.write(spark.range(3000).select(F.col("id").cast("string")), run_name("s", 0))
    filters = spark.read.parquet(index.filters_path())
    assert filters.agg(F.sum("ids")).first()[0] == 3000 and filters.count() > 2 * id_index.BUCKETS
    assert spark.read.parquet(index.ids_path(run_name("s", 0))).agg(F.max("file")).first()[0] == 3
    probe = spark.range(2900, 3300).select(F.col("id").cast("string"))
    assert index.candidates(probe).join(probe, "id").count() == 100


def test_a_filter_row_meets_only_ids_of_its_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "ROW_IDS", 16)
    monkeypatch.setattr(id_index, "PROBE_IDS", 64)
    index = IdIndex(str(tmp_path))
    for batch, size in enumerate((400, 3200)):
        values = spark.range(size).select(F.concat(F.lit(f"{batch}-"), F.col("id")).alias("id"))
        index.write(values, run_name("s", batch))
        filters, hashed = index.dealt(values)
        key = ["level", "bucket", "slice"]
        # Each id is sent once for each size of runs, and no group grows with the batch.
        assert hashed.count() == size * filters.select("level").distinct().count()
        assert hashed.groupBy(*key).count().agg(F.max("count")).first()[0] < 100
        assert filters.groupBy(*key).count().agg(F.max("count")).first()[0] <= 2
        assert (run_name("s", batch), 0) in index.hits(values)


def test_many_runs_are_probed_in_slices(spark, tmp_path, monkeypatch):
    index = IdIndex(str(tmp_path))
    known = many_runs(spark, index, 40, 5)
    asked = ids(spark, [*known[::7], "new"])
    found = index.hits(asked)
    monkeypatch.setattr(id_index, "PROBE_RUNS", 4)
    assert index.dealt(asked)[1].select("slice").distinct().count() == 16
    assert index.hits(asked) == found and {run for run, _ in found} >= {run_name("s", i // 5) for i in range(0, 200, 7)}


def test_filters_miss_nothing_and_seldom_err():
    dice = np.random.default_rng(2)
    h1, h2 = dice.integers(-(2**63), 2**63 - 1, (2, 5000))
    import pandas as pd

    row = id_index._row_filter(pd.DataFrame({"h1": h1[:1000], "h2": h2[:1000], "part": 0, "parts": 1, "files": 1})).iloc[0]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))
    found = bits[id_index._places(h1, h2, len(bits)).astype(np.int64)].all(axis=1)
    assert found[:1000].all() and found[1000:].sum() <= 2 and len(bits) <= 24 * 1000 + 8


def test_merging_keeps_answers_and_bounds_runs(spark, tmp_path):
    index = IdIndex(str(tmp_path))
    for batch in range(9):
        index.write(ids(spark, [f"{batch}-{i}" for i in range(5)]), run_name("s", batch))
    assert index.merge(spark, "s", 9, fan=10) is None and index.merge(spark, "t", 9, fan=2) is None
    while index.merge(spark, "s", 8, fan=2):
        pass
    assert [covered(r) for r in index.runs(spark)] == [("s", 0, 8), ("s", 8, 9)]
    probe = ids(spark, [f"{b}-2" for b in range(12)])
    assert index.candidates(probe).join(probe, "id").count() == 9
    # A merge that was stopped before it removed what it merged.
    index.write(ids(spark, ["3-1"]), run_name("s", 3))
    assert index.candidates(probe).join(probe, "id").select("id").distinct().count() == 9
    assert index.merge(spark, "s", 8, fan=2) is None and len(index.runs(spark)) == 2


def batch(spark, values, start=0):
    return messages(spark, [raw_json(v) for v in values], start=start)


@pytest.mark.parametrize("id_index_on", [True, False])
def test_storage_job_stores_each_id_once(spark, tmp_path, id_index_on):
    store = TableStore(str(tmp_path))
    store.ensure(spark)
    job = FanOut(store, "s1", delays=(), id_index=id_index_on, record_samples=False)
    dice = random.Random(6)
    batches = [[str(dice.randrange(60)) for _ in range(40)] for _ in range(3)]
    for i, values in enumerate([*batches, batches[-1]]):
        job.process(batch(spark, values, i * 100), min(i, 2))
    found = [r.id for r in store.read(spark, "raw_events").select("id").collect()]
    assert sorted(found) == sorted({v for values in batches for v in values})
    assert store.read(spark, "events_timeseries").count() == len(found)


def test_tables_older_than_the_index_are_taken_up(spark, tmp_path):
    store = TableStore(str(tmp_path))
    store.ensure(spark)
    old = FanOut(store, "old", delays=(), id_index=False, record_samples=False)
    old.process(batch(spark, ["a", "b"]), 0)
    old.process(batch(spark, ["c"]), 1)
    assert store.ids.runs(spark) == []
    job = FanOut(store, "new", delays=(), record_samples=False)
    job.process(batch(spark, ["b", "c", "d"]), 0)
    assert sorted(r.id for r in store.read(spark, "raw_events").collect()) == ["a", "b", "c", "d"]
    assert store.ids.runs(spark) == ["new~0", "old~0", "old~1"] and store.complete_ids(spark) == []
