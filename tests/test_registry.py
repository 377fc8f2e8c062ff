"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from tidewatch.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.sql(ORACLE_SQL[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(result.columns, result.fetchall())


def test_the_driver_gets_every_query():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE_SQL.items() <= entry_points.oracle_sql().items()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_entry_gives_the_top_ten(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["repo_name", "count"]
    counts = [row["count"] for row in frame.collect()]
    assert len(counts) == 10 and counts == sorted(counts, reverse=True)
