"""Hash trees name the ids in which two tables differ."""

import pytest
from pyspark.sql import functions as F
from tidewatch.sinks import digests


def tree(rows, folder, **options):
    digests.write_tree(rows, str(folder), **options)
    return str(folder)


def found(spark, a, b, **options):
    return sorted((r.id, r.difference) for r in digests.differing_ids(spark, a, b, **options).collect())


def test_one_lost_one_altered_one_new(spark, tmp_path, monkeypatch):
    table = spark.range(200_000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n"), F.lit(None).cast("string").alias("t"))
    other = table.where("id != '777'").withColumn("n", F.when(F.col("id") == "4242", -1).otherwise(F.col("n")))
    extra = spark.createDataFrame([("new", 1, None)], table.schema)
    a, b = tree(table, tmp_path / "a"), tree(other.unionByName(extra), tmp_path / "b")
    read = []
    inside = digests._inside

    def counted(rows, *rest):
        part = inside(rows, *rest)
        read.append(part.count())
        return part

    monkeypatch.setattr(digests, "_inside", counted)
    assert found(spark, a, b) == [("4242", "altered"), ("777", "missing right"), ("new", "missing left")]
    assert read[:2] == [256, 256] and sum(read[2:]) < 3 * 2 * (256 + 256 + 8)
    read.clear()
    assert found(spark, a, a) == [] and sum(read) == 512


@pytest.mark.parametrize("listed", [0, 128])
def test_equals_a_full_join(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(digests, "FILTERED_RANGES", listed)
    left = [("a", 1, "x"), ("a", 1, "x"), ("b", 2, None), ("c", 3, "z"), (None, 4, "n"), ("d", None, "5"), ("", 6, "")]
    right = [("a", 1, "x"), ("b", None, "2"), ("c", 3, "z"), (None, 4, "m"), ("d", None, "5"), ("e", 1, "x"), ("", 6, "")]
    schema = "id string, n long, t string"
    a = tree(spark.createDataFrame(left, schema), tmp_path / "a", levels=(2, 6))
    b = tree(spark.createDataFrame(right, schema), tmp_path / "b", levels=(2, 6))
    got = {(r.id, r.difference) for r in digests.differing_ids(spark, a, b, levels=(2, 6)).collect()}
    assert got == {("a", "altered"), ("b", "altered"), (None, "altered"), ("e", "missing left")}
    empty = tree(spark.createDataFrame([], schema), tmp_path / "none", levels=(2, 6))
    assert digests.differing_ids(spark, a, empty, levels=(2, 6)).count() == 6
    assert digests.differing_ids(spark, empty, empty, levels=(2, 6)).count() == 0
