"""Events clustered by repository and time: few files are read on both access paths, and no row is lost."""

import random
from datetime import timedelta

import pytest
from conftest import events, tuples, utc
from pyspark.sql import functions as F

from tidewatch.operators import activity
from tidewatch.sinks.clustering import interleaved, newest, of_repository, rank_starts, read_bounds, write_clustered

FILES = 64


def one_day(count, seed=4):
    """Events of one day, a third of them of one repository."""
    dice = random.Random(seed)
    return [
        (str(i), "PushEvent", "hot/one" if dice.random() < 1 / 3 else f"r/{dice.randrange(300):03}", f"a{i % 7}",
         utc(2026, 5, 5) + timedelta(milliseconds=dice.randrange(86_400_000)))
        for i in range(count)
    ]


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    rows = one_day(12_800)
    path = str(tmp_path_factory.mktemp("clustered") / "events")
    write_clustered(events(spark, rows), path, file_rows=len(rows) // FILES)
    return rows, path


def feed(rows, limit, repo=None):
    found = sorted(((at, id) for id, _, name, _, at in rows if repo in (None, name)), reverse=True)
    return [id for _, id in found[:limit]]


def test_bits_are_interleaved(spark):
    pair = spark.range(64).select((F.col("id") / 8).cast("int").alias("a"), (F.col("id") % 8).cast("int").alias("b"))
    found = tuples(pair.select("a", "b", interleaved(F.col("a"), F.col("b"), 3).alias("z")))
    for a, b, z in found:
        assert z == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2)
    assert sorted(z for _, _, z in found) == list(range(64))


def test_ranks_share_the_events_evenly(spark, tmp_path):
    rows = one_day(5_000, seed=9)
    starts = rank_starts(events(spark, rows), str(tmp_path / "ranks"), bits=4)
    names = sorted(row[2] for row in rows)
    first = {}
    for at in range(len(names) - 1, -1, -1):
        first[names[at]] = at * 16 // len(names)
    for name, rank in starts:
        assert first[name] == rank
    ranks = {name: max([0, *(rank for start, rank in starts if start <= name)]) for name in first}
    assert ranks == first


def test_every_row_is_written_once(spark, day):
    rows, path = day
    read = spark.read.parquet(f"{path}/rows")
    assert sorted(tuples(read.select("id", "type", "repo_name", "actor_name", "created_at"))) == sorted(
        (i, t, r, a, at.replace(tzinfo=None)) for i, t, r, a, at in rows
    )
    bounds = read_bounds(spark, path).collect()
    assert sum(b.rows for b in bounds) == len(rows) and FILES / 2 < len(bounds) <= FILES
    assert max(b.rows for b in bounds) < 3 * len(rows) / FILES


@pytest.mark.parametrize("repo", ["r/000", "r/150", "r/299"])
def test_a_repository_is_in_few_files_of_a_day(spark, day, repo):
    rows, path = day
    found = of_repository(spark, path, repo)
    assert len(found.inputFiles()) < FILES / 3
    assert [r.id for r in activity.recent_events(found, repo, 50).collect()] == feed(rows, 50, repo)


def test_a_hot_repository_is_whole(spark, day):
    rows, path = day
    found = of_repository(spark, path, "hot/one")
    assert found.count() == sum(1 for row in rows if row[2] == "hot/one")


def test_the_newest_are_in_few_files_of_a_day(spark, day):
    rows, path = day
    found = newest(spark, path, 10)
    assert len(found.inputFiles()) < FILES / 3
    assert [r.id for r in activity.latest_events(found, 10).collect()] == feed(rows, 10)


@pytest.mark.parametrize("least", [1, 100, 12_800, 99_999])
def test_the_newest_for_any_number(spark, day, least):
    rows, path = day
    found = newest(spark, path, least).orderBy(F.desc("created_at"), F.desc("id")).limit(least)
    assert [r.id for r in found.collect()] == feed(rows, least)


def test_unknown_repositories_and_empty_tables(spark, day, tmp_path):
    assert of_repository(spark, day[1], "none").collect() == []
    path = str(tmp_path / "empty")
    write_clustered(events(spark, []), path)
    assert newest(spark, path, 5).collect() == [] and of_repository(spark, path, "x").collect() == []


def test_ties_and_repeated_rows(spark, tmp_path):
    rows = [("7", "PushEvent", "r/a", "x", utc(2026, 5, 5))] * 30 + [("8", "ForkEvent", "r/b", "y", utc(2026, 5, 4, 23, 59))]
    path = str(tmp_path / "ties")
    write_clustered(events(spark, rows), path, file_rows=4)
    assert of_repository(spark, path, "r/a").count() == 30
    assert [r.id for r in activity.latest_events(newest(spark, path, 40), 40).collect()] == ["7"] * 30 + ["8"]
