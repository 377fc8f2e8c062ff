"""Vectors of any magnitude and files read back by many tasks."""

import math

import public_tokenizers
from pyspark.sql import functions as F
from tidewatch.llm import hnsw, token_files
from tidewatch.session import working_folder


def test_vectors_of_any_magnitude_link(spark):
    rows = []
    for scale in (1.0, 1e200, 1e-200, 5e-324, 1e308):
        rows += [[x * scale for x in (1.0, 2.0, 3.0)], [x * scale for x in (1.0, 2.0, 3.1)]] if 1e-300 < scale < 1e300 else [[scale, 0.0, 0.0]]
    table = spark.createDataFrame([(i, "a", v) for i, v in enumerate(rows)], "vec_id long, label string, embedding array<double>")

    def cosine(a, b):
        a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    want = {i: sum(j != i and cosine(a, b) >= 0.93 for j, b in enumerate(rows)) for i, a in enumerate(rows)}
    assert {r.vec_id: r.n_links for r in hnsw.near_vectors(table).collect()} == want
    assert sorted(want.values()) == [1, 1, 5, 5, 5, 5, 5, 5]


def test_files_are_read_back_by_many_tasks(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text"))
    folder, path = working_folder(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")
    kept = f"{folder}/manifest"
    token_files.write_files(docs.repartition(8), path, f"{folder}/files").write.parquet(kept)
    first = spark.read.parquet(kept)
    again = first.unionAll(first).unionAll(first).unionAll(first)
    spread = token_files.read_files(again, f"{folder}/files")
    tasks = spread.groupBy(F.spark_partition_id()).count().count()
    assert spread.rdd.getNumPartitions() == again.count() and tasks >= min(2, first.count())
    found = token_files.read_files(first, f"{folder}/files").orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(4000))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(found, found[1:]))
