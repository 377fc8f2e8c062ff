"""The topic in files: offsets, keyed order, epochs that repeat, batches that cut files, restarts and lag."""

import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from conftest import raw_json
from pyspark.sql import functions as F

from tidewatch.sinks.publish import start_publishing
from tidewatch.sinks.store import TableStore
from tidewatch.sources import topic_log
from tidewatch.sources.topic import stream_topic_log
from tidewatch.sources.topic_log import Log, LogStreamWriter, limited, newest_offsets
from tidewatch.streaming.fanout import FanOut, start_fan_out
from tidewatch.streaming.monitor import _offsets


@pytest.fixture(scope="module")
def session(spark):
    return topic_log.register(spark)


def records(spark, count, keys=7, start=0):
    ids = spark.range(start, start + count, numPartitions=3)
    return ids.select(F.concat(F.lit("k"), F.col("id") % keys).alias("key"), F.lpad(F.col("id").cast("string"), 9, "0").alias("value"))


def put(frame, path, partitions=4):
    frame.write.format("topic_log").mode("append").option("path", path).option("partitions", partitions).save()


def test_reads_back_what_was_written(session, tmp_path):
    path = str(tmp_path / "t")
    assert session.read.format("topic_log").option("path", path).load().count() == 0
    put(records(session, 3000), path)
    put(records(session, 500, start=3000), path)
    put(session.createDataFrame([(None, "x"), ("k", None), ("ü", "é")], "key string, value string"), path)
    rows = session.read.format("topic_log").option("path", path).option("topic", "t").option("taskOffsets", 100).load().collect()
    assert sorted((r.key, r.value) for r in rows if r.value and r.value.isdigit()) == sorted((f"k{i % 7}", f"{i:09}") for i in range(3500))
    assert len(rows) == 3503 and {r.topic for r in rows} == {"t"}
    by = defaultdict(list)
    for r in rows:
        by[r.partition].append(r)
        assert r.partition == zlib.crc32((r.key if r.key is not None else r.value).encode()) % 4
    for some in by.values():
        some.sort(key=lambda r: r.offset)
        assert [r.offset for r in some] == list(range(len(some)))
        order = defaultdict(list)
        for r in some:
            order[r.key].append(r.value)
        assert all(v == sorted(v) for k, v in order.items() if k and len(k) == 2 and k != "k")


def test_a_repeated_epoch_leaves_one_copy(tmp_path):
    path = str(tmp_path / "t")
    writer = LogStreamWriter({"path": path, "partitions": "2", "writer": "q"})
    batch = pa.RecordBatch.from_pydict({"key": ["a", "b", "c"], "value": ["1", "2", "3"]})
    for _ in range(2):
        writer.commit([writer.write(iter([batch])), None], 0)
    lost = writer.write(iter([batch]))  # a task whose epoch never ended
    assert sum(Log(path).newest().values()) == 3
    writer.abort([lost], 1)
    writer.commit([writer.write(iter([batch])), writer.write(iter([batch]))], 1)
    assert sum(Log(path).newest().values()) == 9 and Log(path).last()["epochs"] == {"q": 1}
    spans = Log(path).files_between({}, Log(path).newest())
    for partition in {s[0] for s in spans}:
        ends = [(first, first + rows) for p, _, first, rows in spans if p == partition]
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("most", [1, 2, 5, 100, None])
def test_limits_share_what_is_there(most):
    at, newest, seen = {}, {"0": 10, "1": 3, "2": 0, "7": 20}, 0
    for _ in range(40):
        end = limited(at, newest, most)
        step = sum(end.values()) - sum(at.values())
        assert all(at.get(p, 0) <= end[p] <= newest[p] for p in newest) and (most is None or step <= most)
        assert step == min(33 - seen, 33 if most is None else most)
        seen, at = seen + step, end
    assert at == newest


def progress(query):
    return [p for p in query.recentProgress if p.numInputRows]


def test_batches_cut_files_and_a_restart_resumes(session, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("t", "out", "check"))
    put(records(session, 1000), path)

    def run(most):
        stream = stream_topic_log(session, path, max_offsets=most)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
            return progress(query)
        finally:
            query.stop()

    first = run(300)
    assert [p.numInputRows for p in first] == [300, 300, 300, 100]
    end = _offsets(first[-1].sources[0].endOffset)
    assert end == newest_offsets(path) and sum(end["activity-events"].values()) == 1000
    put(records(session, 250, start=1000), path)
    again = run(200)
    assert [p.numInputRows for p in again] == [200, 50]
    rows = session.read.parquet(out)
    assert rows.count() == rows.select("partition", "offset").distinct().count() == 1250


def test_the_storage_job_reads_it_and_knows_its_lag(session, tmp_path):
    path, store = str(tmp_path / "t"), TableStore(str(tmp_path / "tables"))
    values = [(f"k{i % 5}", raw_json(str(i))) for i in range(90)] + [("k", "{")]
    put(session.createDataFrame(values, "key string, value string"), path)
    stream = stream_topic_log(session, path, max_offsets=40)
    job = FanOut(store, "log", delays=())
    query = start_fan_out(stream, job, str(tmp_path / "check"), interval="0 seconds", newest=lambda: newest_offsets(path))
    query.processAllAvailable()
    query.stop()
    assert store.read(session, "raw_events").count() == 90 and store.read(session, "dead_letters").count() == 1
    lags = [r.value for r in store.read(session, "metric_samples").where("metric = 'consumer_lag'").orderBy("batch_id").collect()]
    assert lags == [51.0, 11.0] and job.metrics.gauges["consumer_lag"] == 0


def test_published_streams_keep_order_and_survive_a_restart(session, tmp_path):
    landed, path = str(tmp_path / "landed"), str(tmp_path / "t")
    for turn in range(2):
        records(session, 200, start=200 * turn).coalesce(1).sortWithinPartitions("value").write.mode("append").parquet(landed)
        stream = session.readStream.schema("key string, value string").parquet(landed)
        start_publishing(stream, str(tmp_path / "check"), log=path, available_now=True, stream_id="pub").awaitTermination()
    rows = session.read.format("topic_log").option("path", path).load().collect()
    assert sorted(r.value for r in rows) == [f"{i:09}" for i in range(400)]
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.partition, r.offset)):
        by[r.key].append(r.value)
    assert all(v == sorted(v) for v in by.values())
