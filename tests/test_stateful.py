"""Streams with state of their own, against plain versions."""

import random
from datetime import timedelta

import pytest
from conftest import utc
from tidewatch.operators import metrics
from tidewatch.streaming.hours import late_rows, read_hours, start_hours
from tidewatch.streaming.last_ids import dedupe_last
from tidewatch.streaming.monitor import JobMetrics
from tidewatch.streaming.series import stream_increases, sum_increases

T0 = utc(2026, 5, 5)
EVENT = "id string, type string, repo_name string, created_at timestamp, seq long, big long"
SAMPLE = "ts timestamp, metric string, labels map<string, string>, value double"


def landed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def run(frame, folder):
    query = frame.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
    query.trigger(availableNow=True).start().awaitTermination()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    dice, rows = random.Random(3), []
    for i in range(600):
        rows.append((str(i), dice.choice("ab"), "r", T0 + timedelta(seconds=i * 60 + dice.choice((0, 0, 0, -20000))), i, None))
    want, dropped, watermark, seen = {}, 0, None, set()
    counts, path = JobMetrics(), f"{tmp_path}/hours"
    queries = []
    for at in range(0, 600, 200):
        part = rows[at : at + 200] + rows[max(0, at - 5) : at]
        dice.shuffle(part)
        landed(spark, f"{tmp_path}/in", part, EVENT)
        for r in part:
            if watermark is not None and r[3] <= watermark:
                dropped += 1
            elif r[0] not in seen:
                seen.add(r[0])
                key = (r[3].replace(minute=0, second=0, tzinfo=None), r[1])
                want[key] = want.get(key, 0) + 1
        watermark = max(r[3] for r in rows[: at + 200]) - timedelta(hours=2)
        events = spark.readStream.schema(EVENT).parquet(f"{tmp_path}/in")
        query = start_hours(events, path, f"{tmp_path}/check", "2 hours", available_now=True, metrics=counts)
        query.awaitTermination()
        queries.append(query)
    got = {(r.hour.replace(tzinfo=None), r.event_type): r["count"] for r in read_hours(spark, path).collect()}
    assert got == want and 0 < dropped == sum(map(late_rows, queries))
    copies = 600 + 10 - dropped - sum(want.values())
    assert 0 <= copies <= 10


def test_increases_in_batches_equal_the_whole_table(spark, tmp_path):
    dice, value, rows = random.Random(7), {"a": 0, "b": 0}, []
    for second in range(0, 9000, 61):
        for series in value:
            value[series] = 0 if dice.random() < 0.1 else value[series] + dice.randrange(9)
            if dice.random() < 0.8:
                rows.append((T0 + timedelta(seconds=second), "c", {"s": series, "z": "1"}, float(value[series])))
    cuts = [0, 1, 60, 61, len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        part = rows[a:b] + rows[max(0, a - 2) : a]  # the last samples come twice
        dice.shuffle(part)
        landed(spark, f"{tmp_path}/in", part + [(None, "c", {}, 1.0), (T0, "c", None, None)], SAMPLE)
        run(stream_increases(spark.readStream.schema(SAMPLE).parquet(f"{tmp_path}/in"), 900), tmp_path)
    found = sum_increases(spark.read.parquet(f"{tmp_path}/out"))

    def plain(frame):
        return {(r.metric, tuple(sorted(r.labels.items())), r.window_start): r.increase for r in frame.collect()}

    assert plain(found) == plain(metrics.increases(spark.createDataFrame(rows, SAMPLE), 900))


def test_silent_series_start_anew(spark, tmp_path):
    batches = [[(0, "a", 5), (0, "b", 1)], [(1000, "b", 4)], [(1001, "a", 9), (1002, "b", 6), (500, "c", 7), (1001, "c", 8)]]
    for batch in batches:
        landed(spark, f"{tmp_path}/in", [(T0 + timedelta(seconds=s), "m", {"s": n}, float(v)) for s, n, v in batch], SAMPLE)
        run(stream_increases(spark.readStream.schema(SAMPLE).parquet(f"{tmp_path}/in"), 3600, expiry_seconds=100), tmp_path)
    found = sum_increases(spark.read.parquet(f"{tmp_path}/out")).collect()
    # b's first sample of the second batch comes in time; a was forgotten, and the sample of c at 500 is too old.
    assert {r.labels["s"]: r.increase for r in found} == {"a": 0.0, "b": 3.0 + 2.0, "c": 0.0}


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_one_shard_is_one_list_of_the_last_ids(spark, tmp_path, limit):
    dice = random.Random(limit)
    rows = [(dice.choice(("", None, str(dice.randrange(12)))), "t", "r", T0, i, None if i % 3 else 2**60 + i) for i in range(90)]
    known, want = [], []
    for r in rows:
        if r[0] and r[0] not in known:
            known = [*known, r[0]][-limit:]
            want.append((r[0], r[4], r[5]))
    for part in (rows[:40], rows[40:]):
        landed(spark, f"{tmp_path}/in", dice.sample(part, len(part)), EVENT)
        run(dedupe_last(spark.readStream.schema(EVENT).parquet(f"{tmp_path}/in"), limit, ["seq"], shards=1), tmp_path)
    out = spark.read.schema(EVENT).parquet(f"{tmp_path}/out").orderBy("seq")
    assert [(r.id, r.seq, r.big) for r in out.collect()] == want


def test_shards_share_the_ids(spark, tmp_path):
    rows = [(str(i % 40), "t", "r", T0, i, None) for i in range(120)]
    landed(spark, f"{tmp_path}/in", rows, EVENT)
    run(dedupe_last(spark.readStream.schema(EVENT).parquet(f"{tmp_path}/in"), 40, ["seq"], shards=8), tmp_path)
    assert sorted(r.seq for r in spark.read.schema(EVENT).parquet(f"{tmp_path}/out").collect()) == list(range(40))
