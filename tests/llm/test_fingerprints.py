"""Fingerprints against whole shingle sets, and their SQL."""

import hashlib
import random
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import fingerprints, queries

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))
from check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, sketch string, group string, turn string, takers string, sha string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "k", "k", "k", "k", "k") for r in rows], SCHEMA)


def test_query_equals_sql(spark):
    frame = queries.op11_fingerprints(spark, SF)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duck.sql(queries.ORACLE_SQL["op11_fingerprints"])
    assert rows_of(frame.columns, frame.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("span", [1, 10**6, 2**40, 2**63 - 1])
def test_next_row_is_the_next_smaller_id(spark, span):
    dice = random.Random(span)
    ids = list({dice.randrange(-span, span) for _ in range(min(900, span))} - {2**63 - 1}) + [None, 2**63 - 1]
    rows = [(i, f"text of {i}") for i in ids]
    if span == 10**6:
        rows += [(rows[0][0], "twin"), rows[1], rows[1]]
    found = sorted((r.doc_id is None, -(r.doc_id or 0), r.text, r.next_text) for r in fingerprints.with_next(made(spark, rows)).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest()))
    want = [(a[0] is None, -(a[0] or 0), a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])]
    assert found == sorted(want)


def test_groups_far_apart_and_many(spark):
    ids = [x * 10**12 + y for x in range(300) for y in range(3)] + list(range(5000))
    found = {r.doc_id: r.next_text for r in fingerprints.with_next(made(spark, [(i, str(i)) for i in set(ids)])).collect()}
    order = sorted(set(ids), reverse=True)
    assert found == {a: str(b) for a, b in zip(order, order[1:] + order[:1])}


def test_estimates_and_merging(spark):
    dice = random.Random(1)
    words = [f"w{dice.randrange(10**6)}" for _ in range(12_000)]
    texts = [words[:9000], words[3000:12_000], words[:3000], words[:4], [], words[:40]]
    rows = {r.doc_id: r.sketch for r in fingerprints.fingerprints(made(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])).collect()}
    assert [len(rows[i]) for i in range(6)] == [128, 128, 128, 1, 0, 36] and all(s == sorted(set(s)) for s in rows.values())
    table = spark.createDataFrame([(rows[a], rows[b]) for a, b in ((0, 1), (0, 2), (4, 4), (4, 0), (2, 0), (0, 0))], "a array<bigint>, b array<bigint>")
    got = table.select(
        fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.containment(F.col("a"), F.col("b")),
        fingerprints.distinct_shingles(F.col("a")), fingerprints.as_hashes(fingerprints.as_text(F.col("a"))) == F.col("a"),
    ).collect()
    assert abs(got[0][0] - 0.5) < 0.15 and abs(got[0][1] - 2 / 3) < 0.15 and abs(got[1][1] - 1 / 3) < 0.15 and got[3][1] == got[2][1] == 1.0 and abs(got[0][2] / 9000 - 1) < 0.3
    assert abs(got[1][0] - 1 / 3) < 0.15 and (got[2][0], got[2][2]) == (1.0, 0.0) and got[3][0] == 0.0
    assert got[4][1] == 1.0
    assert got[5][0] == 1.0 and all(r[3] for r in got)
    sketches = spark.createDataFrame([("g", rows[0]), ("g", rows[1]), ("h", rows[4]), (None, rows[5])], "source string, sketch array<bigint>")
    merged = {r.source: r.sketch for r in fingerprints.merged_groups(sketches, ["source"]).collect()}
    assert merged == {"g": sorted({*rows[0], *rows[1]})[:128], "h": [], None: rows[5]}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x " * 30_000), (3, "x " * 30_000), (9, "日本" * 50_000), (4, "one two three four five six")]
    found = fingerprints.half_edited(made(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_chars == by_id[2].n_chars == 0 and by_id[1].sketch == by_id[2].sketch == []
    assert by_id[9].edited == "日本" * 25_000 + "one two three four five six" and len(by_id[3].sketch) == 1
    assert by_id[4].edited == "one two three " + ("x " * 13)[:13] and len(by_id[4].sketch) == 2
    assert fingerprints.half_edited(made(spark, [])).count() == 0
    alone = fingerprints.half_edited(made(spark, [(5, "a b c d e f")])).collect()
    assert alone[0].edited == "a b c" .ljust(6) + "a b c" and alone[0].next_sketch == alone[0].sketch
