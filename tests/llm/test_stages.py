"""Stages and mixing on clashing names, repeated rows and very many tiny sources."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import mixing, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NAMES = (
    "_id _hash _sha _text _same _row _raw _kept _label _take _order row hash sha place raw same node label fp keys size first key band rows hashes "
    "tile tiles other ask of_doc of_text of_hash of_source count block quota rounds spans takers sketch doc_id_ c0 c1"
).split()


@pytest.mark.parametrize("at", range(4))
def test_other_columns_come_back_as_they_were(spark, at):
    stage = corpus_pipeline.STAGES[at][1]
    texts = {i: " ".join(f"w{i}x{j}" for j in range(40 + i)) for i in range(12)} | {20: None, 21: "", 22: "Stupid  idiot\tloser"}
    rows = [(i, t, "en", "ab"[i % 2], len(t or ""), *[f"{name} {i}" for name in NAMES]) for i, t in texts.items()]
    table = spark.createDataFrame(rows, ", ".join(f"`{c}` string" if c not in ("doc_id", "n_chars") else f"{c} long" for c in [*COLUMNS, *NAMES]))
    found = stage(spark, table, "/root/testdata/sf0.001")
    assert found.columns == table.columns
    got = found.collect()
    assert got and all(r[name] == f"{name} {r.doc_id}" for r in got for name in NAMES)
    if corpus_pipeline.STAGES[at][0] != "mix_sources":
        assert {r.doc_id: r.text for r in got}.items() <= texts.items()
    if at == 2:
        assert simhash.one_of_each(table).columns == table.columns


def test_one_row_of_each_component_stays(spark):
    base = " ".join(f"w{j}" for j in range(200))
    rows = [(None, "a b"), (None, "a b"), (3, "x y"), (3, "x y"), (7, base), (6, base + " more"), (6, base + " more"), (None, base), (9, None), (8, "")]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.drop_near_copies(spark, table, "").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter([(None, "a b"), (3, "x y"), (6, base + " more"), (8, "")])


def test_repeated_rows_are_dealt_one_by_one(spark):
    text = " ".join(f"w{j}" for j in range(300))
    rows = [(1, text, "en", "a", 9)] * 3 + [(2, text + " z", "de", "b", 9), (None, "u v w", None, None, None), (None, "u v w", None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dealt = mixing.mix(table).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()
    found = corpus_pipeline.mix_sources(spark, table, "").collect()
    words = Counter()
    for r in found:
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == {r.doc_id: r.taken for r in dealt if r.taken}


def test_tiny_sources_come_near_their_targets(spark):
    rows = [(i, "w " * 8, f"s{i:04}") for i in range(1000)] + [(10_000 + i, "v " * 1000, "large") for i in range(100)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 1100
    by = Counter()
    for r in found:
        assert r.taken <= 2 * r["size"]
        by[r.source] += r.taken
    for r in found:
        assert abs(by[r.source] - r.target) <= max(1, r.target / 16 + 1), r


def test_equal_rows_fill_many_shards(spark):
    table = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("s").alias("source"))
    found = mixing.mix(table)
    assert found.count() == 20_000
    total = found.agg(F.sum("taken"), F.first("target")).first()
    assert abs(total[0] - total[1]) <= 1500
    assert found.select("spans", "rounds").distinct().count() > 2
    # One shard would hold equal spans for equal places; shards of SHARD_ROWS rows choose by themselves.
    assert mixing.SHARD_ROWS < 20_000


def test_words_are_those_dealt(spark):
    table = spark.createDataFrame([(i, " ".join(f"t{i}w{j}" for j in range(500)), "en", "a", 1) for i in range(8)], "doc_id long, text string, lang string, source string, n_chars long")
    spans = {r.doc_id: r for r in mixing.mix(table).collect()}
    texts = {r.doc_id: r.text for r in table.collect()}
    want = Counter()
    for i, r in spans.items():
        words = re.findall(r"\S+", texts[i])
        want.update([texts[i]] * r.rounds)
        if r.spans:
            want[" ".join(w for s in r.spans.split() for w in words[int(s.split("-")[0]) : int(s.split("-")[1])])] += 1
    assert Counter(r.text for r in corpus_pipeline.mix_sources(spark, table, "").collect()) == want
