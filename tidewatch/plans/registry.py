"""Every query by name, with the SQL that gives the same rows from the same tables.

A query takes (spark, sf_dir) and reads whole tables. Queries without SQL are
marked so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.contract import parse_events, rejected_messages, valid_events
from tidewatch.functions.timebuckets import cutoff, hour_bucket, parse_rfc3339
from tidewatch.operators import activity, audit, metrics, rollup
from tidewatch.operators import events as ev
from tidewatch.plans import driver_tables as dt
from tidewatch.plans import landing
from tidewatch.plans.dashboard import dashboard
from tidewatch.schemas import EVENT_COLUMNS, TOPIC_COLUMNS
from tidewatch.session import configure
from tidewatch.sinks import clustering
from tidewatch.sources.snapshot import explode_snapshots
from tidewatch.sources.synthetic import synthetic_events, synthetic_messages
from tidewatch.streaming.fanout import DEAD_LETTER_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# Parameters of the registered queries.
REPO = "org/repo-042"
EVENT_ID = "777"
RUN = "purchase"
SNAPSHOT_EVENTS = 100
BATCH_OFFSETS = 1000

_JSON = (
    """'{"id":"' || id || '","type":"' || type || '","repo":{' || %s || '},"actor":{"login":"' || actor_name"""
    """ || '"},"created_at":"' || %s || '"}'"""
)
_REPO_JSON = """'"name":"' || repo_name || '"'"""
_TIME_JSON = "strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"
_REASON = """CASE WHEN event_id % 97 = 0 THEN 'invalid json'
            WHEN event_id % 89 = 0 THEN 'missing required field repo.name'
            WHEN event_id % 83 = 0 THEN 'invalid created_at' END"""

# The data model of the mapped table, in front of every query's SQL.
_MODEL = f"""WITH mapped AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id, event_type AS type,
         'org/repo-' || lpad(json_extract_string(props, '$.k'), 3, '0') AS repo_name,
         'user-' || CAST(user_id AS VARCHAR) AS actor_name, ts AS created_at, value AS amount,
         CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset"
  FROM events),
bounds AS (SELECT max(ts) AS as_of, min(ts) AS started_at FROM events),
raw AS (SELECT *, {_JSON % (_REPO_JSON, _TIME_JSON)} AS payload FROM mapped),
hourly AS (
  SELECT date_trunc('hour', created_at) AS hour, repo_name, type AS event_type, count(*) AS count
  FROM raw GROUP BY ALL),
timeseries AS (
  SELECT date_trunc('second', created_at) AS "timestamp", type AS event_type, repo_name FROM raw),
topic AS (
  SELECT *, repo_name AS key, 'activity' AS topic, created_at AS "timestamp", {_REASON} AS reason,
         CASE WHEN event_id % 97 = 0 THEN left(payload, 20)
              WHEN event_id % 89 = 0 THEN {_JSON % ("''", _TIME_JSON)}
              WHEN event_id % 83 = 0 THEN {_JSON % (_REPO_JSON, "'not-a-time'")}
              ELSE payload END AS value
  FROM raw),
valid AS (SELECT * FROM topic WHERE reason IS NULL),
done AS (
  SELECT *, NOT (value LIKE '%"type":"error"%' AND created_at >= (SELECT as_of FROM bounds) - INTERVAL 24 HOUR) AS done
  FROM topic)
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, its SQL after the data model."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return dt.without_zones(run(configure(spark), sf_dir))

        QUERIES[name] = configured
        if sql is not None:
            ORACLE_SQL[name] = _MODEL + sql
        return run

    return register


def _valid(messages: DataFrame) -> DataFrame:
    return valid_events(parse_events(messages))


def _now(spark: SparkSession, sf_dir: str):
    return dt.as_of(spark, sf_dir).cast("timestamp")


# Sources

@query("src_snapshot_explode", "SELECT payload AS value FROM raw")
def src_snapshot_explode(spark, sf_dir):
    pages = (
        dt.raw(spark, sf_dir)
        .groupBy(F.floor(F.col("id").cast("long") / SNAPSHOT_EVENTS).alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("payload"), ","), F.lit("]")).alias("value"))
    )
    return explode_snapshots(pages.select("value"))


@query("src_topic_scan", 'SELECT key, value, topic, "partition", "offset", "timestamp" FROM topic')
def src_topic_scan(spark, sf_dir):
    return dt.topic(spark, sf_dir).select(*TOPIC_COLUMNS)


@query("scan_raw_events", "SELECT id, type, repo_name, actor_name, created_at, payload FROM raw")
def scan_raw_events(spark, sf_dir):
    return dt.raw(spark, sf_dir).select(*EVENT_COLUMNS)


@query("scan_hourly", "SELECT * FROM hourly")
def scan_hourly(spark, sf_dir):
    return dt.hourly(spark, sf_dir)


@query("scan_timeseries", "SELECT * FROM timeseries")
def scan_timeseries(spark, sf_dir):
    return dt.timeseries(spark, sf_dir)


_SYNTHETIC = """, synthetic AS (
  SELECT event_id AS i, 'bench-' || printf('%06d', event_id) AS id,
         ['PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent', 'ForkEvent'][event_id % 5 + 1] AS type,
         'bench/repo-' || printf('%03d', event_id % 100) AS repo_name,
         'bench-actor-' || printf('%03d', event_id % 250) AS actor_name,
         (SELECT as_of FROM bounds) - to_hours(event_id % 24) AS created_at
  FROM events)
"""


@query(
    "synthetic_topic_events",
    _SYNTHETIC
    + """SELECT repo_name AS key,
    '{"id":"' || id || '","type":"' || type || '","repo":{"name":"' || repo_name || '"},"actor":{"login":"' || actor_name
    || '"},"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || 'Z","synthetic":true,"index":' || i || '}' AS value
    FROM synthetic""",
)
def synthetic_topic_events(spark, sf_dir):
    index = dt.events(spark, sf_dir).select(F.col("event_id").alias("i"))
    return synthetic_messages(index, "bench", _now(spark, sf_dir))


@query(
    "synthetic_analytics",
    _SYNTHETIC
    + """SELECT date_trunc('hour', created_at) AS hour, repo_name, type AS event_type, count(*) AS count
    FROM synthetic GROUP BY ALL""",
)
def synthetic_analytics(spark, sf_dir):
    index = dt.events(spark, sf_dir).select(F.col("event_id").alias("i"))
    return rollup.hourly_partials(synthetic_events(index, "bench", _now(spark, sf_dir)))


_SAMPLES = """, requests AS (
  SELECT 'GET' AS method, '/' || event_type AS path, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
         value / CAST(100 AS DOUBLE) AS duration, ts AS created_at
  FROM events),
bucket AS (
  SELECT * FROM (VALUES ('0.005', 0.005e0), ('0.01', 0.01e0), ('0.025', 0.025e0), ('0.05', 0.05e0), ('0.1', 0.1e0),
    ('0.25', 0.25e0), ('0.5', 0.5e0), ('1', 1e0), ('2.5', 2.5e0), ('5', 5e0), ('10', 10e0),
    ('+Inf', CAST('infinity' AS DOUBLE))) AS t(le, bound)),
processed AS (
  SELECT event_type AS operation, ts, CAST(sum(n) OVER (PARTITION BY event_type, date_trunc('week', ts) ORDER BY ts) AS DOUBLE) AS value
  FROM (SELECT event_type, date_trunc('minute', ts) AS ts, count(*) AS n FROM events GROUP BY ALL) AS c),
request_count AS (
  SELECT method, path, status, ts,
         CAST(sum(n) OVER (PARTITION BY method, path, status, date_trunc('week', ts) ORDER BY ts) AS DOUBLE) AS value
  FROM (SELECT method, path, status, date_trunc('hour', created_at) AS ts, count(*) AS n FROM requests GROUP BY ALL) AS c),
lag_gauge AS (
  SELECT event_type AS operation, date_trunc('hour', ts) AS ts, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY ALL),
duration_bucket AS (
  SELECT path, le, bound, ts,
         CAST(sum(n) OVER (PARTITION BY path, le, date_trunc('week', ts) ORDER BY ts) AS DOUBLE) AS value
  FROM (SELECT path, le, bound, date_trunc('hour', created_at) AS ts, count(*) FILTER (WHERE duration <= bound) AS n
        FROM requests, bucket GROUP BY ALL) AS c)
"""


@query(
    "scan_metric_samples",
    _SAMPLES
    + """SELECT ts, 'events_processed_total' AS metric, 'operation=' || operation AS labels, value FROM processed
    UNION ALL SELECT ts, 'api_requests_total', 'method=' || method || ',path=' || path || ',status=' || status, value FROM request_count
    UNION ALL SELECT ts, 'consumer_lag', 'operation=' || operation, value FROM lag_gauge
    UNION ALL SELECT ts, 'api_request_duration_seconds_bucket', 'le=' || le || ',path=' || path, value FROM duration_bucket""",
)
def scan_metric_samples(spark, sf_dir):
    samples = (
        dt.processed_samples(spark, sf_dir)
        .unionByName(dt.request_samples(spark, sf_dir))
        .unionByName(dt.lag_samples(spark, sf_dir))
        .unionByName(dt.duration_samples(spark, sf_dir))
    )
    pairs = F.transform(
        F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return samples.select("ts", "metric", F.array_join(pairs, ",").alias("labels"), "value")


# Contract

@query("parse_events", "SELECT id, type, repo_name, actor_name, created_at, payload FROM valid")
def parse(spark, sf_dir):
    return _valid(dt.topic(spark, sf_dir)).select(*EVENT_COLUMNS)


@query("contract_reasons", 'SELECT "partition", "offset", reason FROM topic')
def contract_reasons(spark, sf_dir):
    return parse_events(dt.topic(spark, sf_dir)).select("partition", "offset", "reason")


@query(
    "parse_rfc3339",
    """SELECT "partition", "offset", CASE WHEN event_id % 83 = 0 AND event_id % 89 > 0 THEN 'not-a-time'
      ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS text,
    CASE WHEN event_id % 83 > 0 OR event_id % 89 = 0 THEN created_at END AS created_at
    FROM topic WHERE reason IS DISTINCT FROM 'invalid json'""",
)
def rfc3339(spark, sf_dir):
    text = F.get_json_object("value", "$.created_at")
    return (
        dt.topic(spark, sf_dir)
        .select("partition", "offset", text.alias("text"))
        .filter(F.col("text").isNotNull())
        .withColumn("created_at", parse_rfc3339(F.col("text")))
    )


@query("hour_bucket", "SELECT id, date_trunc('hour', created_at) AS hour FROM raw")
def hours(spark, sf_dir):
    return dt.raw(spark, sf_dir).select("id", hour_bucket(F.col("created_at")).alias("hour"))


@query(
    "filter_allowed",
    """SELECT id, type, repo_name, actor_name, created_at FROM valid
    WHERE type IN ('click', 'purchase', 'signup', 'view')""",
)
def filter_allowed(spark, sf_dir):
    return ev.feed(ev.filter_allowed(_valid(dt.topic(spark, sf_dir)), dt.TABLE_ALLOWED_TYPES))


@query("dedupe_first", "SELECT id, type, repo_name, actor_name, created_at, 0 AS delivery FROM valid")
def dedupe_first(spark, sf_dir):
    first = ev.keep_first(_valid(dt.redelivered(spark, sf_dir)), ["delivery", "offset"])
    return first.select("id", "type", "repo_name", "actor_name", "created_at", "delivery")


# Writes

@query("publish_keyed", "SELECT key, value FROM valid")
def publish_keyed(spark, sf_dir):
    return ev.publish_keyed(_valid(dt.topic(spark, sf_dir)))


@query(
    "dead_letters",
    """SELECT key, value, topic, "partition", "offset", reason, 'decode' AS stage FROM topic WHERE reason IS NOT NULL""",
)
def dead_letters(spark, sf_dir):
    return rejected_messages(parse_events(dt.topic(spark, sf_dir))).select(*DEAD_LETTER_COLUMNS)


@query(
    "raw_insert_if_absent",
    """SELECT id, type, repo_name, actor_name, created_at FROM valid
    WHERE created_at >= (SELECT as_of FROM bounds) - INTERVAL 168 HOUR""",
)
def raw_insert_if_absent(spark, sf_dir):
    stored = dt.raw(spark, sf_dir).filter(F.col("created_at") < cutoff(_now(spark, sf_dir), 168))
    new = ev.keep_first(_valid(dt.redelivered(spark, sf_dir)), ["delivery", "offset"])
    return ev.feed(ev.insert_if_absent(new, stored))


def _batched(spark, sf_dir):
    batch = F.floor(F.col("offset") / BATCH_OFFSETS).alias("batch_id")
    return dt.raw(spark, sf_dir).select("*", batch)


@query(
    "hourly_partials",
    """SELECT "offset" // 1000 AS batch_id, date_trunc('hour', created_at) AS hour, repo_name, type AS event_type,
    count(*) AS count FROM raw GROUP BY ALL""",
)
def hourly_partials(spark, sf_dir):
    return rollup.hourly_partials(_batched(spark, sf_dir), ("batch_id",))


@query("compact_hourly", "SELECT * FROM hourly")
def compact_hourly(spark, sf_dir):
    return rollup.compact_hourly(rollup.hourly_partials(_batched(spark, sf_dir), ("batch_id",)))


@query("merged_batches", "SELECT r.*, t.timeseries FROM (SELECT repo_name, event_type, sum(count)::BIGINT AS hourly FROM hourly GROUP BY ALL) r "
    "JOIN (SELECT repo_name, event_type, count(*) AS timeseries FROM timeseries GROUP BY ALL) t USING (repo_name, event_type)")
def merged_batches(spark, sf_dir):
    store = landing.tiered(spark, sf_dir)
    keys = ["repo_name", "event_type"]
    hourly = store.read(spark, "events_hourly").groupBy(*keys).agg(F.sum("count").alias("hourly"))
    return hourly.join(store.read(spark, "events_timeseries").groupBy(*keys).agg(F.count("*").alias("timeseries")), keys)


@query("timeseries_rows", 'SELECT date_trunc(\'second\', created_at) AS "timestamp", type AS event_type, repo_name FROM valid')
def timeseries_rows(spark, sf_dir):
    return rollup.timeseries_rows(_valid(dt.topic(spark, sf_dir)))


# Rollups and read queries

@query("hourly_rollup", "SELECT date_trunc('hour', created_at) AS hour, repo_name, type AS event_type, count(*) AS count FROM valid GROUP BY ALL")
def hourly_rollup(spark, sf_dir):
    return rollup.hourly_rollup(_valid(dt.topic(spark, sf_dir)))


_IN_WINDOW = "WHERE hour >= (SELECT as_of FROM bounds) - INTERVAL 24 HOUR"
_TRENDING = f"""SELECT repo_name, CAST(sum(count) AS BIGINT) AS count FROM hourly {_IN_WINDOW}
    GROUP BY repo_name ORDER BY count DESC, repo_name LIMIT 10"""
_BREAKDOWN = f"""SELECT event_type, CAST(sum(count) AS BIGINT) AS count FROM hourly {_IN_WINDOW} GROUP BY event_type"""
_SHARE = "count * CAST(100 AS DOUBLE) / greatest(max(count) OVER (), 1) AS share"
_CONTRIBUTORS = """SELECT actor_name, count(*) AS count FROM raw WHERE repo_name = {repo}
    GROUP BY actor_name ORDER BY count DESC, actor_name LIMIT 10"""
_RECENT = """SELECT id, type, repo_name, actor_name, created_at FROM raw {where}
    ORDER BY created_at DESC, id DESC LIMIT {limit}"""
_TOP_REPO = f"(SELECT repo_name FROM ({_TRENDING}) AS t ORDER BY count DESC, repo_name LIMIT 1)"


@query("trending_repos", _TRENDING)
def trending_repos(spark, sf_dir):
    start, as_of = dt.window(spark, sf_dir, 24)
    return activity.trending_repos(dt.hourly(spark, sf_dir, start), as_of, 24, 10)


@query("event_breakdown", _BREAKDOWN)
def event_breakdown(spark, sf_dir):
    start, as_of = dt.window(spark, sf_dir, 24)
    return activity.event_breakdown(dt.hourly(spark, sf_dir, start), as_of, 24)


@query("breakdown_share", f"SELECT *, {_SHARE} FROM ({_BREAKDOWN}) AS b")
def breakdown_share(spark, sf_dir):
    return activity.with_share_of_max(event_breakdown(spark, sf_dir))


@query("top_contributors", _CONTRIBUTORS.format(repo=f"'{REPO}'"))
def top_contributors(spark, sf_dir):
    return activity.top_contributors(landing.written(spark, sf_dir, "raw_events"), REPO, 10)


@query("contributors_share", f"SELECT *, {_SHARE} FROM ({_CONTRIBUTORS.format(repo=repr(REPO))}) AS c")
def contributors_share(spark, sf_dir):
    return activity.with_share_of_max(top_contributors(spark, sf_dir))


@query("recent_events", _RECENT.format(where=f"WHERE repo_name = '{REPO}'", limit=50))
def recent_events(spark, sf_dir):
    return activity.recent_events(landing.written(spark, sf_dir, "raw_events"), REPO, 50)


@query("latest_events", _RECENT.format(where="", limit=10))
def latest_events(spark, sf_dir):
    return activity.latest_events(landing.written(spark, sf_dir, "raw_events"), 10)


@query("recent_events_clustered", _RECENT.format(where=f"WHERE repo_name = '{REPO}'", limit=50))
def recent_events_clustered(spark, sf_dir):
    events = clustering.of_repository(spark, landing.clustered(spark, sf_dir), REPO)
    return activity.recent_events(events, REPO, 50)


@query("latest_events_clustered", _RECENT.format(where="", limit=10))
def latest_events_clustered(spark, sf_dir):
    return activity.latest_events(clustering.newest(spark, landing.clustered(spark, sf_dir), 10), 10)


@query(
    "latest_timeseries",
    """SELECT "timestamp", repo_name, event_type FROM timeseries
    ORDER BY "timestamp" DESC, repo_name, event_type LIMIT 10""",
)
def latest_timeseries(spark, sf_dir):
    return activity.latest_timeseries(landing.written(spark, sf_dir, "events_timeseries"), 10)


@query(
    "hourly_listing",
    "SELECT hour, repo_name, event_type, count FROM hourly ORDER BY hour DESC, repo_name, event_type LIMIT 10",
)
def hourly_listing(spark, sf_dir):
    return activity.hourly_listing(landing.written(spark, sf_dir, "events_hourly"), 10)


@query(
    "repo_breakdown",
    f"SELECT event_type, CAST(sum(count) AS BIGINT) AS count FROM hourly WHERE repo_name = '{REPO}' GROUP BY event_type",
)
def repo_breakdown(spark, sf_dir):
    return activity.repo_breakdown(landing.written(spark, sf_dir, "events_hourly"), REPO)


@query("repo_event_ids", f"SELECT id, type FROM raw WHERE repo_name = '{REPO}'")
def repo_event_ids(spark, sf_dir):
    return activity.repo_event_ids(landing.written(spark, sf_dir, "raw_events"), REPO)


@query("event_by_id", f"SELECT id, type, repo_name, actor_name FROM raw WHERE id = '{EVENT_ID}'")
def event_by_id(spark, sf_dir):
    return activity.event_by_id(landing.written(spark, sf_dir, "raw_events"), EVENT_ID)


@query(
    "event_trend",
    """SELECT date_trunc('hour', "timestamp") AS hour, event_type, count(*) AS count FROM timeseries GROUP BY ALL""",
)
def event_trend(spark, sf_dir):
    return activity.event_trend(dt.timeseries(spark, sf_dir))


@query("top_repo_contributors", _CONTRIBUTORS.format(repo=_TOP_REPO))
def top_repo_contributors(spark, sf_dir):
    start, as_of = dt.window(spark, sf_dir, 24)
    hourly = dt.hourly(spark, sf_dir, start)
    return activity.top_repo_contributors(landing.written(spark, sf_dir, "raw_events"), hourly, as_of, 24, 10)


@query("top_repo_recent", _RECENT.format(where=f"WHERE repo_name = {_TOP_REPO}", limit=10))
def top_repo_recent(spark, sf_dir):
    start, as_of = dt.window(spark, sf_dir, 24)
    hourly = dt.hourly(spark, sf_dir, start)
    return activity.top_repo_recent(landing.written(spark, sf_dir, "raw_events"), hourly, as_of, 24, 10)


@query(
    "dashboard_top_repo",
    f"""SELECT 'trending' AS panel, repo_name AS item, count, CAST(NULL AS DOUBLE) AS share FROM ({_TRENDING}) AS t
    UNION ALL SELECT 'breakdown', event_type, count, {_SHARE} FROM ({_BREAKDOWN}) AS b
    UNION ALL SELECT 'contributors', actor_name, count, {_SHARE} FROM ({_CONTRIBUTORS.format(repo=_TOP_REPO)}) AS c
    UNION ALL SELECT 'feed', id, NULL, NULL FROM ({_RECENT.format(where=f"WHERE repo_name = {_TOP_REPO}", limit=10)}) AS f""",
)
def dashboard_top_repo(spark, sf_dir):
    start, as_of = dt.window(spark, sf_dir, 24)
    return dashboard(landing.written(spark, sf_dir, "raw_events"), dt.hourly(spark, sf_dir, start), as_of, 24, 10).as_rows()


# Audits

@query("duplicate_ids", "SELECT id, CAST(2 AS BIGINT) AS count FROM valid")
def duplicate_ids(spark, sf_dir):
    return audit.duplicate_ids(_valid(dt.redelivered(spark, sf_dir)))


@query("id_summary", f"SELECT count(*) AS count, max(type) AS type FROM raw WHERE id = '{EVENT_ID}'")
def id_summary(spark, sf_dir):
    return audit.id_summary(landing.written(spark, sf_dir, "raw_events"), EVENT_ID)


@query(
    "repo_totals",
    f"""SELECT '{REPO}' AS repo_name,
    (SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM hourly WHERE repo_name = '{REPO}') AS hourly_count,
    (SELECT count(*) FROM timeseries WHERE repo_name = '{REPO}') AS timeseries_rows""",
)
def repo_totals(spark, sf_dir):
    return audit.repo_totals(landing.written(spark, sf_dir, "events_hourly"), landing.written(spark, sf_dir, "events_timeseries"), REPO)


@query(
    "prefix_totals",
    f"""SELECT (SELECT count(*) FROM raw WHERE type || '-' || id LIKE '{RUN}-%') AS raw_rows,
    (SELECT count(*) FROM raw WHERE type || '/' || repo_name LIKE '{RUN}/%') AS hourly_count""",
)
def prefix_totals(spark, sf_dir):
    raw, hourly = (landing.written_runs(spark, sf_dir, table) for table in ("raw_events", "events_hourly"))
    return audit.prefix_totals(raw, hourly, RUN)


@query(
    "reconcile_stores",
    """SELECT repo_name, type AS event_type, count(*) AS published, count(*) AS raw_rows, 2 * count(*) AS hourly_count,
    CAST(0 AS BIGINT) AS raw_diff, count(*) AS hourly_diff FROM valid GROUP BY ALL""",
)
def reconcile_stores(spark, sf_dir):
    # A rollup fed by both deliveries against raw rows stored once: the audit shows the surplus.
    delivered = _valid(dt.redelivered(spark, sf_dir))
    published = _valid(dt.topic(spark, sf_dir))
    raw = ev.keep_first(delivered, ["delivery", "offset"])
    return audit.reconcile_stores(published, raw, rollup.hourly_partials(delivered))


_CONTIGUOUS = """, islands AS (
  SELECT topic, "partition", "offset", done,
         count(*) FILTER (WHERE NOT done) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS gaps
  FROM done),
ends AS (
  SELECT topic, "partition", max("offset") AS latest_offset, min("offset") AS first_offset,
         max("offset") FILTER (WHERE gaps = 0) AS contiguous_offset
  FROM islands GROUP BY ALL)
"""


@query("contiguous_offsets", _CONTIGUOUS + 'SELECT topic, "partition", contiguous_offset FROM ends')
def contiguous_offsets(spark, sf_dir):
    return audit.contiguous_offsets(dt.topic(spark, sf_dir), dt.is_done(spark, sf_dir))


@query(
    "topic_lag",
    _CONTIGUOUS
    + """SELECT topic, "partition", latest_offset, contiguous_offset,
    latest_offset - coalesce(contiguous_offset, first_offset - 1) AS lag FROM ends""",
)
def topic_lag(spark, sf_dir):
    return audit.topic_lag(dt.topic(spark, sf_dir), dt.is_done(spark, sf_dir))


@query(
    "per_repo_sequence",
    """SELECT id, repo_name, row_number() OVER (PARTITION BY repo_name ORDER BY "offset", "partition") AS seq FROM raw""",
)
def per_repo_sequence(spark, sf_dir):
    messages = dt.raw(spark, sf_dir).select("id", "repo_name", "offset", "partition")
    return ev.per_repo_sequence(messages).select("id", "repo_name", "seq")


@query(
    "load_summary",
    """SELECT type, count(*) AS events, (epoch_us(max(created_at)) - epoch_us(min(created_at))) / CAST(1000000 AS DOUBLE) AS duration_seconds,
    count(*) / ((epoch_us(max(created_at)) - epoch_us(min(created_at))) / CAST(1000000 AS DOUBLE)) AS events_per_second
    FROM raw GROUP BY type""",
)
def load_summary(spark, sf_dir):
    return audit.load_summary(dt.raw(spark, sf_dir), "type")


@query(
    "activity_snapshot",
    """SELECT 'ok' AS status, started_at, (epoch_us(as_of) - epoch_us(started_at)) // 1000000 AS uptime_seconds,
    (SELECT count(*) FROM topic) AS events_ingested_total, (SELECT count(*) FROM valid) AS events_processed_total,
    (SELECT count(*) FROM topic WHERE reason IS NOT NULL) AS events_failed_total FROM bounds""",
)
def activity_snapshot(spark, sf_dir):
    return audit.parsed_snapshot(parse_events(dt.topic(spark, sf_dir)))


@query(
    "acceptance_report",
    _CONTIGUOUS
    + """SELECT count(*) AS published, count(*) AS raw_rows, count(*) AS hourly_count, count(*) AS timeseries_rows,
    (SELECT 2 * count(*) FROM topic WHERE reason IS NOT NULL) AS dead_letters,
    (SELECT CAST(sum(latest_offset - coalesce(contiguous_offset, first_offset - 1)) AS BIGINT) FROM ends) AS lag,
    TRUE AS stores_agree, FALSE AS passed FROM valid""",
)
def acceptance_report(spark, sf_dir):
    # Over the tables the storage job wrote; every refused message was delivered twice.
    topic = dt.topic(spark, sf_dir)
    store = landing.stored(spark, sf_dir)
    return audit.acceptance_report(
        _valid(topic),
        store.read(spark, "raw_events"),
        store.read(spark, "events_hourly"),
        store.read(spark, "events_timeseries"),
        store.read(spark, "dead_letters"),
        audit.topic_lag(topic, dt.is_done(spark, sf_dir)),
    )


# Metric samples

_DELTA = """CASE WHEN previous IS NULL THEN 0 WHEN value < previous THEN value ELSE value - previous END"""
_PROCESSED_DELTAS = f""", deltas AS (
  SELECT ts, {_DELTA} AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY operation ORDER BY ts) AS previous FROM processed) AS p)
"""


@query(
    "metric_throughput",
    _SAMPLES
    + _PROCESSED_DELTAS
    + """SELECT date_trunc('hour', ts) AS window_start, sum(delta) / CAST(3600 AS DOUBLE) AS rate FROM deltas GROUP BY ALL""",
)
def metric_throughput(spark, sf_dir):
    return metrics.rate(dt.processed_samples(spark, sf_dir), "events_processed_total", 3600)


@query(
    "metric_increase_15m",
    _SAMPLES
    + _PROCESSED_DELTAS
    + """SELECT coalesce(sum(delta), CAST(0 AS DOUBLE)) AS increase FROM deltas, bounds
    WHERE ts > as_of - INTERVAL 15 MINUTE AND ts <= as_of""",
)
def metric_increase_15m(spark, sf_dir):
    return metrics.increase_since(
        dt.processed_samples(spark, sf_dir), "events_processed_total", _now(spark, sf_dir), 15
    )


@query(
    "metric_error_rates",
    _SAMPLES
    + f"""SELECT date_trunc('day', ts) AS window_start, path, status, sum({_DELTA}) / CAST(86400 AS DOUBLE) AS rate
    FROM (SELECT *, lag(value) OVER (PARTITION BY method, path, status ORDER BY ts) AS previous FROM request_count) AS r
    WHERE regexp_matches(status, '^5..$') GROUP BY ALL""",
)
def metric_error_rates(spark, sf_dir):
    return metrics.rate(
        dt.request_samples(spark, sf_dir), "api_requests_total", 86400, ("path", "status"), metrics.server_errors()
    )


@query(
    "metric_latest",
    _SAMPLES
    + """SELECT operation, max(ts) AS ts, arg_max(value, ts) AS value FROM lag_gauge GROUP BY operation""",
)
def metric_latest(spark, sf_dir):
    newest = metrics.latest(dt.lag_samples(spark, sf_dir), "consumer_lag")
    return newest.select(F.col("labels")["operation"].alias("operation"), "ts", "value")


@query(
    "metric_totals",
    _SAMPLES
    + """SELECT 'events_processed_total' AS metric, sum(value) AS total
    FROM (SELECT operation, arg_max(value, ts) AS value FROM processed GROUP BY operation) AS p""",
)
def metric_totals(spark, sf_dir):
    return metrics.total(dt.processed_samples(spark, sf_dir), "events_processed_total")


_QUANTILE = """ranked AS (
  SELECT *, max(n) OVER (PARTITION BY g) AS total, lag(n, 1, 0) OVER (PARTITION BY g ORDER BY bound) AS below,
         lag(bound, 1, 0) OVER (PARTITION BY g ORDER BY bound) AS lower
  FROM cumulative),
quantiles AS (
  SELECT *, CASE WHEN le = '+Inf' THEN lower ELSE
    lower + (bound - lower) * ((CAST(0.95 AS DOUBLE) * total - below) / (n - below)) END AS quantile
  FROM ranked WHERE below < CAST(0.95 AS DOUBLE) * total AND n >= CAST(0.95 AS DOUBLE) * total)
"""


@query(
    "metric_p95_bucketed",
    _SAMPLES
    + f""", cumulative AS (
      SELECT date_trunc('day', ts) AS g, le, bound, sum({_DELTA}) / CAST(86400 AS DOUBLE) AS n
      FROM (SELECT *, lag(value) OVER (PARTITION BY path, le ORDER BY ts) AS previous FROM duration_bucket) AS d
      GROUP BY ALL), {_QUANTILE} SELECT g AS window_start, quantile FROM quantiles""",
)
def metric_p95_bucketed(spark, sf_dir):
    return metrics.quantile_of_rates(dt.duration_samples(spark, sf_dir), "api_request_duration_seconds", 86400)


@query(
    "metric_p95_exact",
    _SAMPLES
    + """, ranked AS (
      SELECT path, duration, row_number() OVER (PARTITION BY path ORDER BY duration) - 1 AS place,
             count(*) OVER (PARTITION BY path) AS n
      FROM requests WHERE duration IS NOT NULL),
    sought AS (SELECT *, (n - 1) * CAST(0.95 AS DOUBLE) AS position FROM ranked),
    ends AS (
      SELECT path, n AS observations, position, max(duration) FILTER (WHERE place = floor(position)) AS low,
             max(duration) FILTER (WHERE place = ceil(position)) AS high
      FROM sought GROUP BY ALL)
    SELECT path, observations, CASE WHEN low = high THEN low ELSE low + (high - low) * (position - floor(position)) END AS quantile
    FROM ends""",
)
def metric_p95_exact(spark, sf_dir):
    return metrics.exact_quantile(dt.requests(spark, sf_dir), "duration", 0.95, ["path"])


@query(
    "metric_histogram",
    _SAMPLES
    + """SELECT path, le, count(*) FILTER (WHERE duration <= bound) AS count FROM requests, bucket GROUP BY ALL""",
)
def metric_histogram(spark, sf_dir):
    return metrics.histogram(dt.requests(spark, sf_dir), "duration", ["path"])


@query(
    "request_summary",
    _SAMPLES
    + f""", cumulative AS (
      SELECT method || path || status AS g, method, path, status, le, bound,
             CAST(count(*) FILTER (WHERE duration <= bound) AS DOUBLE) AS n
      FROM requests, bucket GROUP BY ALL), {_QUANTILE}
    SELECT method, path, status, CAST(total AS BIGINT) AS requests, quantile AS p95_seconds FROM quantiles""",
)
def request_summary(spark, sf_dir):
    return metrics.request_summary(dt.requests(spark, sf_dir))


# Streams

@query("fanout_end_to_end", "SELECT id, type, repo_name, actor_name, created_at, payload FROM valid")
def fanout_end_to_end(spark, sf_dir):
    return landing.stored(spark, sf_dir).read(spark, "raw_events").select(*EVENT_COLUMNS)


@query("stream_hourly", "SELECT date_trunc('hour', created_at) AS hour, repo_name, type AS event_type, count(*) AS count FROM valid GROUP BY ALL")
def stream_hourly(spark, sf_dir):
    return rollup.compact_hourly(landing.stored(spark, sf_dir).read(spark, "events_hourly"))


@query(
    "stream_route",
    """SELECT 'stored' AS route, CAST(NULL AS VARCHAR) AS reason, count(*) AS messages FROM valid
    UNION ALL SELECT 'dead letter', reason, 2 * count(*) FROM topic WHERE reason IS NOT NULL GROUP BY reason""",
)
def stream_route(spark, sf_dir):
    store = landing.stored(spark, sf_dir)
    kept = store.read(spark, "raw_events").agg(F.count("*").alias("messages"))
    refused = store.read(spark, "dead_letters").groupBy("reason").agg(F.count("*").alias("messages"))
    return kept.select(
        F.lit("stored").alias("route"), F.lit(None).cast("string").alias("reason"), "messages"
    ).unionByName(refused.select(F.lit("dead letter").alias("route"), "reason", "messages"))


@query(
    "tables_exist",
    """SELECT 'raw_events' AS table_name, count(*) AS row_count FROM valid
    UNION ALL SELECT 'events_timeseries', count(*) FROM valid
    UNION ALL SELECT 'events_hourly', count(*) FROM (SELECT DISTINCT date_trunc('hour', created_at), repo_name, type FROM valid) AS h
    UNION ALL SELECT 'dead_letters', 2 * count(*) FROM topic WHERE reason IS NOT NULL""",
)
def tables_exist(spark, sf_dir):
    store = landing.stored(spark, sf_dir)
    counts = [
        store.read(spark, table).agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count"))
        for table in ("raw_events", "events_timeseries", "events_hourly", "dead_letters")
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


@query("stream_dedupe", "SELECT id, type FROM valid")
def stream_dedupe(spark, sf_dir):
    return landing.deduplicated(spark, sf_dir).select("id", "type")


@query(
    "ingest_accepted",
    "SELECT key, value FROM valid WHERE type IN ('click', 'purchase', 'signup', 'view')",
)
def ingest_accepted(spark, sf_dir):
    return landing.ingested(spark, sf_dir)


@query("microbatch_counts", "SELECT 2 * count(*) AS messages, TRUE AS one_file_per_batch FROM topic")
def microbatch_counts(spark, sf_dir):
    return landing.batch_counts(spark, sf_dir)


@query(
    "topic_log_messages",
    """SELECT key, value, count(*) OVER (PARTITION BY key) AS of_key, TRUE AS one_partition FROM valid""",
)
def topic_log_messages(spark, sf_dir):
    """The keyed messages as read back from the topic log: each key in one partition, each partition's offsets without gaps."""
    return landing.logged(spark, sf_dir)


@query("topic_log_batches", "SELECT count(*) AS messages, count(*) AS offsets, TRUE AS bounded FROM valid")
def topic_log_batches(spark, sf_dir):
    return landing.log_batches(spark, sf_dir)


@query(
    "stream_hourly_watermark",
    """SELECT date_trunc('hour', created_at) AS hour, repo_name, type AS event_type, count(*) AS count,
    (SELECT count(*) FROM valid WHERE created_at <= (SELECT date_trunc('millisecond', max(created_at)) FROM valid) - INTERVAL 1 DAY) AS late
    FROM valid GROUP BY ALL""",
)
def stream_hourly_watermark(spark, sf_dir):
    """The second delivery is late or, inside the last day, a copy: counts stay those of one delivery."""
    return landing.watermarked(spark, sf_dir, "1 day")


@query("stream_dedupe_last", "SELECT id, type FROM valid")
def stream_dedupe_last(spark, sf_dir):
    return landing.remembered(spark, sf_dir)


@query(
    "stream_throughput",
    _SAMPLES
    + _PROCESSED_DELTAS
    + """SELECT date_trunc('hour', ts) AS window_start, sum(delta) / CAST(3600 AS DOUBLE) AS rate FROM deltas GROUP BY ALL""",
)
def stream_throughput(spark, sf_dir):
    found = landing.increased(spark, sf_dir, 3600)
    return found.groupBy("window_start").agg((F.sum("increase") / F.lit(3600.0)).alias("rate"))


@query("differing_ids", "SELECT id, 'missing right' AS difference FROM topic WHERE reason IS NOT NULL")
def differing_ids(spark, sf_dir):
    return landing.differences(spark, sf_dir)
