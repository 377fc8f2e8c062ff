"""Table schemas (as DDL) and the fixed values of the event contract."""

# The event types kept at ingest, in generator order.
ALLOWED_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "ForkEvent",
)

# Waits between attempts of a failing write, in seconds.
RETRY_DELAYS = (0.1, 0.5, 2.0)

# Bounds and defaults of the query parameters.
MAX_HOURS = 168
MAX_LIMIT = 100
DEFAULT_TRENDING_HOURS = 1
DEFAULT_BREAKDOWN_HOURS = 24
DEFAULT_TRENDING_LIMIT = 10
DEFAULT_CONTRIBUTORS_LIMIT = 10
DEFAULT_RECENT_LIMIT = 50
DEFAULT_LISTING_LIMIT = 10

# Upper bounds of the default latency histogram, in seconds.
DEFAULT_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

# Trigger intervals of the storage job and of the landing poll.
BATCH_INTERVAL = "5 seconds"
POLL_INTERVAL = "30 seconds"

DEFAULT_TOPIC = "activity-events"
DEFAULT_DEAD_LETTER_TOPIC = "activity-events-dlq"

EVENT_COLUMNS = ("id", "type", "repo_name", "actor_name", "created_at", "payload")
TOPIC_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

EVENT_SCHEMA = (
    "id STRING, type STRING, repo_name STRING, actor_name STRING, "
    "created_at TIMESTAMP, payload STRING"
)
TOPIC_SCHEMA = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# Every stream-written table ends in these partition columns.
BATCH_COLUMNS = "stream_id STRING, batch_id BIGINT"
DAY_BATCH_COLUMNS = BATCH_COLUMNS + ", dt DATE"

TABLE_SCHEMAS = {
    "raw_events": f"{EVENT_SCHEMA}, {DAY_BATCH_COLUMNS}",
    "events_hourly": (
        "hour TIMESTAMP, repo_name STRING, event_type STRING, count BIGINT, " + DAY_BATCH_COLUMNS
    ),
    "events_timeseries": (
        "timestamp TIMESTAMP, event_type STRING, repo_name STRING, " + DAY_BATCH_COLUMNS
    ),
    "dead_letters": (
        "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, "
        "reason STRING, stage STRING, " + BATCH_COLUMNS
    ),
    "metric_samples": (
        "ts TIMESTAMP, metric STRING, labels MAP<STRING, STRING>, value DOUBLE, " + BATCH_COLUMNS
    ),
}

# The order rows are sorted in inside each file, so that row-group statistics
# prune the reads each table is made for.
TABLE_SORT = {
    "raw_events": ("repo_name", "created_at"),
    "events_hourly": ("hour", "repo_name", "event_type"),
    "events_timeseries": ("timestamp", "repo_name"),
}
