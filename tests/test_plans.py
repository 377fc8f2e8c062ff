"""The physical plans the engine counts on."""

from datetime import timedelta

import pytest
from conftest import SF_DIR, utc
from pyspark.sql import functions as F

from tidewatch.operators import activity, metrics
from tidewatch.operators.rollup import hourly_partials
from tidewatch.plans import driver_tables as dt
from tidewatch.plans.registry import QUERIES
from tidewatch.session import configure, working_folder
from tidewatch.sinks.store import write_for_reading

NOW = utc(2024, 1, 30, 23, 59)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    raw = dt.raw(spark, SF_DIR).drop("partition", "offset")
    write_for_reading(raw, "raw_events", f"{root}/raw")
    write_for_reading(hourly_partials(raw), "events_hourly", f"{root}/hourly")
    return spark.read.parquet(f"{root}/raw"), spark.read.parquet(f"{root}/hourly")


def executed(frame):
    """The executed plan's nodes, adaptive stages and subqueries included."""
    frame.collect()
    nodes = []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        nodes.append((name, plan))
        if name.endswith("QueryStageExec"):
            walk(plan.plan())
        for part in (plan.children(), plan.subqueries()):
            for i in range(part.size()):
                walk(part.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return nodes


def scans(frame):
    return [
        {key: str(plan.metadata().apply(key)) for key in ("PushedFilters", "PartitionFilters", "ReadSchema")}
        | {"files": plan.metrics().apply("numFiles").value(), "rows": plan.metrics().apply("numOutputRows").value()}
        for name, plan in executed(frame)
        if name == "FileSourceScanExec"
    ]


def test_trending_prunes_days_and_takes_the_top(tables):
    frame = activity.trending_repos(tables[1], NOW, 24, 10)
    (scan,) = scans(frame)
    assert "GreaterThanOrEqual(hour" in scan["PushedFilters"]
    assert "dt" in scan["PartitionFilters"] and scan["files"] <= 4
    assert "event_type" not in scan["ReadSchema"]
    assert "TakeOrderedAndProjectExec" in [name for name, _ in executed(frame)]


def test_recent_pushes_the_repo_and_leaves_the_payload(tables):
    frame = activity.recent_events(tables[0], "org/repo-042")
    (scan,) = scans(frame)
    assert "EqualTo(repo_name,org/repo-042)" in scan["PushedFilters"]
    assert "payload" not in scan["ReadSchema"]
    assert not any("ShuffleExchange" in name for name, _ in executed(frame))


def test_top_repo_reaches_the_scan_like_a_literal(tables):
    found = scans(activity.top_repo_recent(*tables, NOW))
    assert any("EqualTo(repo_name,ScalarSubquery" in scan["PushedFilters"] for scan in found)


def test_point_lookup_skips_files_by_bloom_filter(tables):
    (scan,) = scans(activity.event_by_id(tables[0], "777"))
    assert scan["rows"] < tables[0].count() / 10


def test_prefix_is_pushed(tables):
    (scan,) = scans(tables[0].filter(F.col("id").startswith("77")).select("id"))
    assert "StringStartsWith(id,77)" in scan["PushedFilters"]


def test_registered_trending_pushes_its_window(spark):
    found = scans(QUERIES["trending_repos"](spark, SF_DIR))
    assert any("GreaterThanOrEqual(ts,ScalarSubquery" in scan["PushedFilters"] for scan in found)


PUSHED = {
    "top_contributors": "EqualTo(repo_name,org/repo-042)",
    "contributors_share": "EqualTo(repo_name,org/repo-042)",
    "recent_events": "EqualTo(repo_name,org/repo-042)",
    "repo_breakdown": "EqualTo(repo_name,org/repo-042)",
    "repo_event_ids": "EqualTo(repo_name,org/repo-042)",
    "repo_totals": "EqualTo(repo_name,org/repo-042)",
    "event_by_id": "EqualTo(id,777)",
    "id_summary": "EqualTo(id,777)",
    "prefix_totals": "StringStartsWith(",
    "top_repo_contributors": "EqualTo(repo_name,ScalarSubquery",
    "top_repo_recent": "EqualTo(repo_name,ScalarSubquery",
    "dashboard_top_repo": "EqualTo(repo_name,ScalarSubquery",
    "latest_events": "GreaterThanOrEqual(created_at,ScalarSubquery",
    "latest_timeseries": "GreaterThanOrEqual(timestamp,ScalarSubquery",
    "hourly_listing": "GreaterThanOrEqual(hour,ScalarSubquery",
}


@pytest.mark.parametrize("name", PUSHED)
def test_registered_reads_push_their_filter(spark, name):
    found = scans(QUERIES[name](spark, SF_DIR))
    assert any(PUSHED[name] in scan["PushedFilters"] for scan in found)
    assert all("payload" not in scan["ReadSchema"] for scan in found)


def test_newest_rows_are_read_from_the_newest_days(tables):
    frame = activity.latest_events(tables[0], 10)
    total = tables[0].count()
    read = [scan["rows"] for scan in scans(frame) if "created_at" in scan["ReadSchema"]]
    assert read and max(read) < total / 4
    whole = activity.latest_events(tables[0].drop("dt"), 10)
    assert frame.collect() == whole.collect()
    listed = activity.hourly_listing(tables[1], 100)
    assert listed.collect() == activity.hourly_listing(tables[1].drop("dt"), 100).collect()
    assert activity.latest_events(tables[0].filter("id = 'none'"), 10).collect() == []


def test_share_reuses_the_aggregation(tables):
    frame = activity.with_share_of_max(activity.event_breakdown(tables[1], NOW, 168))
    names = [name for name, _ in executed(frame)]
    assert "ReusedExchangeExec" in names and "WindowExec" not in names


def test_rate_never_orders_a_whole_series_of_samples(spark):
    plan = metrics.rate(dt.processed_samples(spark, SF_DIR), "events_processed_total", 3600)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    lags = [line for line in text.split("\n") if "Window [" in line and "lag(value" in line]
    assert lags and all("window_start" in line for line in lags)


STREAMED = {"acceptance_report", "fanout_end_to_end", "ingest_accepted", "microbatch_counts", "stream_dedupe", "stream_hourly", "stream_route", "tables_exist"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_no_python_and_no_pairing_in_any_plan(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_settings_are_pinned_and_the_folder_is_shared(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    first, second = working_folder(spark, "x"), working_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_naive_as_of_is_utc(tables):
    aware = activity.trending_repos(tables[1], NOW, 24, 5).collect()
    assert activity.trending_repos(tables[1], NOW.replace(tzinfo=None), 24, 5).collect() == aware
    shifted = activity.trending_repos(tables[1], NOW + timedelta(days=30), 24, 5)
    assert shifted.collect() == []
