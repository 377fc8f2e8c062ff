import random

from conftest import events, tuples, utc
from pyspark.sql import functions as F

from tidewatch.operators import events as ev
from tidewatch.operators.events import filter_allowed, insert_if_absent, keep_first, publish_keyed

AT = utc(2026, 5, 5)


def test_allowlist_keeps_order(spark):
    rows = [("1", "PushEvent", "r", "a", AT), ("2", "CreateEvent", "r", "a", AT), ("3", "WatchEvent", "r", "a", AT)]
    assert [row.id for row in filter_allowed(events(spark, rows)).collect()] == ["1", "3"]


def test_keep_first_by_order_and_no_empty_ids(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), ("", 0)], "id string, offset int")
    assert sorted(tuples(keep_first(frame, ["offset"]))) == [("a", 1), ("b", 5)]


def test_keep_first_thins_copies_before_the_shuffle(spark):
    hot = F.when(F.col("id") < 990, "hot").otherwise(F.col("id").cast("string"))
    kept = keep_first(spark.range(1000).select(hot.alias("id"), F.col("id").alias("offset")), ["offset"])
    assert sorted(tuples(kept)) == [(str(n), n) for n in range(990, 1000)] + [("hot", 0)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_insert_if_absent_what_is_stored_wins(spark):
    stored = events(spark, [("1", "PushEvent", "r", "a", AT)])
    new = events(spark, [("1", "IssuesEvent", "r", "a", AT), ("2", "ForkEvent", "r", "a", AT)])
    added = insert_if_absent(new, stored)
    assert added.columns == new.columns
    assert [(row.id, row.type) for row in added.collect()] == [("2", "ForkEvent")]


def test_publish_key_is_the_repo_and_value_the_payload(spark):
    frame = events(spark, [("1", "PushEvent", "tide/pool", "a", AT)])
    assert tuples(publish_keyed(frame)) == [("tide/pool", "{}")]


def test_sequence_across_ranges_matches_plain_numbering(spark, monkeypatch):
    monkeypatch.setattr(ev, "SEQUENCE_SPAN", 4)
    rng = random.Random(3)
    rows = [(offset, partition, "hot" if rng.random() < 0.6 else rng.choice("ab")) for offset in range(40) for partition in range(3)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "offset long, partition int, repo_name string")
    got = {(row.offset, row.partition): (row.repo_name, row.seq) for row in ev.per_repo_sequence(frame).collect()}
    counts, want = {}, {}
    for offset, partition, repo in sorted(rows):
        counts[repo] = counts.get(repo, 0) + 1
        want[(offset, partition)] = (repo, counts[repo])
    assert got == want
