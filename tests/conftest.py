import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewatch import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def raw_json(id="1", type="PushEvent", repo="tide/pool", actor="heron", at="2026-03-09T17:28:39Z"):
    return (
        f'{{"id":"{id}","type":"{type}","repo":{{"name":"{repo}"}},'
        f'"actor":{{"login":"{actor}"}},"created_at":"{at}"}}'
    )


def messages(spark, values, topic="t", partition=0, start=0):
    """Topic messages with consecutive offsets."""
    rows = [("k", value, topic, partition, start + i, utc(2026, 5, 5)) for i, value in enumerate(values)]
    return spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    )


def events(spark, rows):
    """Events from (id, type, repo, actor, created_at) tuples."""
    return spark.createDataFrame(
        [(*row, "{}") for row in rows],
        "id string, type string, repo_name string, actor_name string, created_at timestamp, payload string",
    )


def tuples(frame):
    return [tuple(row) for row in frame.collect()]
