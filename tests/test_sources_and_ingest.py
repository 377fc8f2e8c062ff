import json
import os
import time

import pytest
from conftest import messages, raw_json, tuples, utc

from tidewatch.functions.contract import parse_events, valid_events
from tidewatch.sources import synthetic, topic
from tidewatch.sources.snapshot import read_lines, read_snapshots, stream_lines, stream_snapshots
from tidewatch.sinks.publish import publish, start_publishing
from tidewatch.streaming.ingest import accepted_messages, dedupe_stream, refused_messages
from tidewatch.streaming.monitor import JobMetrics, source_lag

NOW = utc(2026, 5, 11, 12)


def test_snapshot_files_split_into_raw_events(spark, tmp_path):
    (tmp_path / "a.json").write_text("[\n" + raw_json("1") + ",\n" + raw_json("2") + ",null]")
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("not json")
    rows = parse_events(read_snapshots(spark, str(tmp_path))).collect()
    assert sorted((row.id or "", row.reason or "") for row in rows) == [
        ("", "invalid json"),
        ("", "missing required field id"),
        ("1", ""),
        ("2", ""),
    ]


def test_lines_keep_every_byte(spark, tmp_path):
    text = '{"n": 1.50,  "x":null}'
    (tmp_path / "a.ndjson").write_text(text + "\n")
    assert tuples(read_lines(spark, str(tmp_path))) == [(text,)]


def test_synthetic_message(spark):
    row = synthetic.synthetic_messages(synthetic.index_range(spark, 7, 8), "bench", NOW).first()
    assert row.key == "bench/repo-007"
    assert json.loads(row.value) == {
        "id": "bench-000007",
        "type": "IssuesEvent",
        "repo": {"name": "bench/repo-007"},
        "actor": {"login": "bench-actor-007"},
        "created_at": "2026-05-11T05:00:00Z",
        "synthetic": True,
        "index": 7,
    }


def test_synthetic_range_and_fixed_payload(spark):
    rows = synthetic.synthetic_events(synthetic.index_range(spark, 10, 13), "seed", NOW).collect()
    assert [row.id for row in rows] == ["seed-000010", "seed-000011", "seed-000012"]
    assert {row.payload for row in rows} == {'{"synthetic":true}'}
    big = synthetic.synthetic_events(synthetic.index_range(spark, 1234567, 1234568), "seed", NOW).first()
    assert (big.id, big.repo_name, big.actor_name) == ("seed-1234567", "seed/repo-067", "seed-actor-067")


def test_synthetic_messages_pass_the_contract(spark):
    parsed = parse_events(synthetic.generate_messages(spark, 50, "load", NOW))
    assert parsed.filter("reason IS NOT NULL").count() == 0
    same = synthetic.generate_events(spark, 50, "load", NOW).drop("payload")
    assert valid_events(parsed).select(*same.columns).exceptAll(same).count() == 0


@pytest.mark.parametrize("count,prefix", [(0, "p"), (5, "  ")])
def test_synthetic_arguments(spark, count, prefix):
    with pytest.raises(ValueError):
        synthetic.generate_messages(spark, count, prefix, NOW)


def test_kafka_options():
    plain = topic.read_options(["a:1", " b:2 "], "t", group="g", max_offsets=100, min_partitions=32)
    assert plain == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "groupIdPrefix": "g",
        "maxOffsetsPerTrigger": "100",
        "minPartitions": "32",
    }
    secured = topic.write_options(["a:1"], "t", username="u", password='p"w')
    assert secured["kafka.security.protocol"] == "SASL_SSL"
    assert secured["kafka.sasl.mechanism"] == "PLAIN"
    assert 'password="p\\"w"' in secured["kafka.sasl.jaas.config"]
    assert (secured["topic"], secured["kafka.acks"]) == ("t", "1")
    with pytest.raises(ValueError, match="brokers are required"):
        topic.read_options([" "])
    with pytest.raises(ValueError, match="topic is required"):
        topic.read_options(["a:1"], " ")


def ingest(spark, tmp_path, stream, metrics=None, **options):
    published = str(tmp_path / "published")
    start_publishing(
        accepted_messages(stream, "30 days", **options),
        str(tmp_path / "cp"),
        path=published,
        available_now=True,
        metrics=metrics,
    ).awaitTermination()
    return sorted(tuples(spark.read.schema("key string, value string").parquet(published)))


@pytest.mark.parametrize("salt", [0, 4])
def test_ingest_filters_before_dedupe_and_publishes_once(spark, tmp_path, salt):
    landed = tmp_path / "landed"
    landed.mkdir()
    # Id 1 comes first with a type that is not kept; it must not block the kept one.
    first = [raw_json("1", "CreateEvent"), raw_json("1", "PushEvent"), raw_json("2", "WatchEvent"), "{"]
    (landed / "a.json").write_text("[" + ",".join(first[:3]) + "]")
    (landed / "b.json").write_text("[" + ",".join([raw_json("2", "WatchEvent"), raw_json("3", "ForkEvent")]) + "]")
    stream = stream_snapshots(spark, str(landed), max_files=1)
    got = ingest(spark, tmp_path, stream, salt_buckets=salt)
    assert [(key, json.loads(value)["id"]) for key, value in got] == [("tide/pool", "1"), ("tide/pool", "2"), ("tide/pool", "3")]
    assert {json.loads(value)["type"] for _, value in got} == {"PushEvent", "WatchEvent", "ForkEvent"}


def test_an_event_of_a_far_future_makes_no_other_late(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    times = ["2999-01-01T00:00:00Z", "2026-05-08T15:00:00Z", "1990-01-01T00:00:00Z", "2026-05-08T15:00:00Z"]
    for n, at in enumerate(times):
        (landed / f"{n}.json").write_text("[" + raw_json(str(n % 3), at=at) + "]")
        os.utime(landed / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    got = ingest(spark, tmp_path, stream_snapshots(spark, str(landed), max_files=1))
    assert sorted(json.loads(value)["id"] for _, value in got) == ["0", "1", "2"]


def test_refused_texts_have_their_own_stream(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.ndjson").write_text(raw_json("1") + '\n{"id":\n')
    out = str(tmp_path / "refused")
    query = refused_messages(stream_lines(spark, str(landed))).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    query.trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    assert tuples(spark.read.schema("value string, reason string, stage string").parquet(out)) == [('{"id":', "invalid json", "ingest")]


def test_salted_dedupe_of_one_hot_id(spark, tmp_path):
    path = str(tmp_path / "topic")
    values = [raw_json("hot")] * 300 + [raw_json(str(n)) for n in range(20)]
    for n in range(3):
        messages(spark, values, partition=n).repartition(4).write.mode("append").parquet(path)
    events = valid_events(parse_events(topic.stream_topic_files(spark, path, max_files=5)))
    out = str(tmp_path / "out")
    writer = dedupe_stream(events, "30 days").select("id").writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    got = sorted(row.id for row in spark.read.schema("id string").parquet(out).collect())
    assert got == sorted(["hot"] + [str(n) for n in range(20)])


def test_publishing_needs_one_target(spark):
    with pytest.raises(ValueError):
        start_publishing(None, "cp")
    with pytest.raises(ValueError):
        publish(None, kafka={}, path="p")


def test_ingest_counts_what_it_published(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.json").write_text("[" + ",".join([raw_json("1"), raw_json("1"), raw_json("2")]) + "]")
    metrics = JobMetrics()
    ingest(spark, tmp_path, stream_snapshots(spark, str(landed)), metrics=metrics)
    deadline = time.time() + 20
    while metrics.counters.get(("events_ingested_total", ""), 0) < 2 and time.time() < deadline:
        time.sleep(0.1)
    assert metrics.counters[("events_ingested_total", "")] == 2


def test_source_lag_of_kafka_progress():
    assert source_lag('{"t":{"0":10,"1":5}}', '{"t":{"0":12,"1":5}}') == 2
    assert source_lag(None, '{"t":{"0":3}}') == 3
    assert source_lag('{"logOffset":1}', None) is None
    assert source_lag('{"logOffset":1}', "not JSON") is None


def test_job_metrics_as_samples(spark):
    metrics = JobMetrics()
    metrics.add("ingest_errors_total", 2, "publish")
    metrics.observe("poll_duration_seconds", 0.03)
    rows = {(row.metric, tuple(row.labels.items())): row.value for row in metrics.samples(spark, NOW).collect()}
    assert rows[("ingest_errors_total", (("operation", "publish"),))] == 2
    assert rows[("poll_duration_seconds_bucket", (("le", "0.025"),))] == 0
    assert rows[("poll_duration_seconds_bucket", (("le", "0.05"),))] == 1
    assert rows[("poll_duration_seconds_sum", ())] == 0.03
