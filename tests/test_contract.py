import pytest
from conftest import messages, raw_json, tuples, utc
from pyspark.sql import functions as F

from tidewatch.functions.contract import check_events, parse_events, rejected_messages, valid_events
from tidewatch.functions.timebuckets import cutoff, format_rfc3339, hour_bucket, parse_rfc3339

REST = '"type":"T","repo":{"name":"o/r"},"actor":{"login":"a"},"created_at":"2026-05-05T01:02:03Z"'


def reasons(spark, values):
    parsed = parse_events(messages(spark, values)).orderBy("offset")
    return [row.reason for row in parsed.select("reason").collect()]


def test_valid_event_keeps_every_field_and_the_exact_payload(spark):
    text = '{"id":"8841", "type":"ForkEvent","repo":{"name":"tide/pool"},"actor":{"login":"heron"},"created_at":"2026-03-09T17:28:39Z","n":1.50}'
    row = valid_events(parse_events(messages(spark, [text]))).first()
    assert (row.id, row.type, row.repo_name, row.actor_name) == ("8841", "ForkEvent", "tide/pool", "heron")
    assert row.payload == text
    assert row.created_at.timestamp() == utc(2026, 3, 9, 17, 28, 39).timestamp()


CASES = {
    '{"id":': "invalid json",
    "": "invalid json",
    None: "invalid json",
    "[]": "invalid json",
    '"text"': "invalid json",
    "12": "invalid json",
    "null": "missing required field id",
    "{}": "missing required field id",
    '{"id":4,' + REST + "}": "invalid json",
    '{"id":null,' + REST + "}": "missing required field id",
    '{"id":"",' + REST + "}": "missing required field id",
    '{"id":"1"}': "missing required field type",
    '{"id":"1","type":"T"}': "missing required field repo.name",
    '{"id":"1","type":"T","repo":{}}': "missing required field repo.name",
    '{"id":"1","type":"T","repo":null}': "missing required field repo.name",
    '{"id":"1","type":"T","repo":"x"}': "invalid json",
    '{"id":"1","type":"T","repo":[]}': "invalid json",
    '{"id":"1","type":"T","repo":{"name":5}}': "invalid json",
    '{"id":"1","type":"T","repo":{"name":"r"}}': "missing required field actor.login",
    '{"id":"1","type":"T","repo":{"name":"r"},"actor":true}': "invalid json",
    '{"id":"1","type":"T","repo":{"name":"r"},"actor":{"login":"a"}}': "missing required field created_at",
    '{"id":"1","id":"2",' + REST + "}": None,
    ' {"id":"1",' + REST + "} \n": None,
    '{"id":"1",' + REST + "} trailing": "invalid json",
    '{"id":"1",' + REST + "}}": "invalid json",
    '{"id":"1",' + REST + '},{"id":"2"}': "invalid json",
    '{"id":"1",' + REST + "}] }": "invalid json",
    '{"id":"1",' + REST + '},{"seal":1}': "invalid json",
    '{"id":"1",' + REST + ',"x":01}': "invalid json",
    '{"id":"1",' + REST + ',"x":NaN}': "invalid json",
    '{"id":"1",' + REST + ",}": "invalid json",
    "{'id':'1'}": "invalid json",
}


def test_reasons(spark):
    got = dict(zip(CASES, reasons(spark, list(CASES))))
    assert got == CASES


def test_check_gives_the_same_rows(spark):
    rows = messages(spark, list(CASES))
    assert sorted(map(str, tuples(check_events(rows)))) == sorted(map(str, tuples(parse_events(rows))))


TIMES = {
    "2026-05-05T01:02:03Z": "2026-05-05T01:02:03Z",
    "2026-05-05T01:02:03+05:30": "2026-05-04T19:32:03Z",
    "2026-05-05T01:02:03.123456789Z": "2026-05-05T01:02:03Z",
    "2026-05-05T01:02:03,5Z": "2026-05-05T01:02:03Z",
    "2026-05-05T1:02:03Z": "2026-05-05T01:02:03Z",
    "2024-02-29T00:00:00Z": "2024-02-29T00:00:00Z",
    "2026-02-30T00:00:00Z": None,
    "2026-05-05": None,
    "2026-05-05T01:02:03": None,
    "2026-05-05 01:02:03Z": None,
    "2026-05-05t01:02:03z": None,
    "2026-05-05T24:00:00Z": None,
    "2026-05-05T01:02:60Z": None,
    "not-a-time": None,
}


def test_rfc3339(spark):
    frame = spark.createDataFrame([(text,) for text in TIMES], "text string")
    rows = frame.select("text", format_rfc3339(parse_rfc3339(F.col("text"))).alias("at")).collect()
    assert {row.text: row["at"] for row in rows} == TIMES


def test_bad_time_is_the_last_check(spark):
    assert reasons(spark, [raw_json(at="not-a-time"), raw_json(actor="", at="not-a-time")]) == [
        "invalid created_at",
        "missing required field actor.login",
    ]


def test_fraction_narrows_to_micros(spark):
    row = parse_events(messages(spark, [raw_json(at="2026-05-05T01:02:03.123456789Z")])).first()
    assert row.created_at.microsecond == 123456


def test_rejected_messages_keep_key_value_and_position(spark):
    row = rejected_messages(parse_events(messages(spark, ['{"id":'], start=7))).first()
    assert (row.key, row.value, row.offset, row.reason, row.stage) == ("k", '{"id":', 7, "invalid json", "decode")


def test_hour_bucket_and_cutoff(spark):
    at = F.lit(utc(2026, 5, 5, 23, 59, 59))
    row = spark.range(1).select(
        format_rfc3339(hour_bucket(at)).alias("hour"),
        format_rfc3339(cutoff(utc(2026, 5, 5, 10, 30), 24)).alias("literal"),
        format_rfc3339(cutoff(F.lit(utc(2026, 5, 5, 10, 30)), 24)).alias("column"),
    ).first()
    assert row.hour == "2026-05-05T23:00:00Z"
    assert row.literal == row.column == "2026-05-04T10:30:00Z"


@pytest.mark.parametrize("columns", [["id"], ["reason"], ["id", "created_at"]])
def test_each_text_is_parsed_once(spark, columns):
    plan = valid_events(parse_events(messages(spark, [raw_json()]))).select(*columns)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1
