"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tidewatch.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(seed, count):
    dice = random.Random(seed)
    for at in range(count):
        if at % 5 == 0:
            yield [dice.randrange(2) for _ in range(dice.randrange(200))]
        elif at % 5 == 1:
            blocks = [[dice.randrange(dice.choice([1, 2, 3, 50])) for _ in range(dice.randrange(1, 40))] for _ in range(4)]
            yield [w for b in blocks for w in b * dice.randrange(1, 9) + b[: dice.randrange(len(b) + 1)]]
        elif at % 5 == 2:
            inner = ([0] * dice.randrange(1, 20) + [1]) * dice.randrange(1, 5) + [dice.randrange(3)]
            yield (inner * dice.randrange(3, 8))[dice.randrange(5) :]
        elif at % 5 == 3:
            a, b = [0], [0, 1]
            for _ in range(dice.randrange(3, 8)):
                a, b = b, b + a
            yield b * dice.randrange(1, 5)
        else:
            yield [1] * dice.randrange(100) + [2] + [1] * dice.randrange(100)


def test_runs_are_those_of_brute_force():
    texts = list(numbers(3, 600))
    arrays = [periodic_runs._numbered([b"%d" % x for x in words]) for words in texts]
    for group in (1, 60, 600):
        found = [r for at in range(0, 600, group) for r in periodic_runs.find_runs(arrays[at : at + group])]
        assert [[tuple(r) for r in rows.tolist()] for rows in found] == [plain_runs(words) for words in texts]


def test_wavelet_tree_counts_and_selects():
    dice = np.random.default_rng(4)
    for size in (1, 2, 7, 64, 100):
        values = dice.permutation(size)
        tree = periodic_runs.WaveletTree(values)
        left = dice.integers(0, size, 50)
        right = np.array([dice.integers(a + 1, size + 1) for a in left])
        bound = dice.integers(0, size + 1, 50)
        assert tree.below(left, right, bound).tolist() == [(values[a:b] < c).sum() for a, b, c in zip(left, right, bound)]
        nth = np.array([dice.integers(0, b - a) for a, b in zip(left, right)])
        assert tree.smallest(left, right, nth).tolist() == [sorted(values[a:b])[c] for a, b, c in zip(left, right, nth)]


def test_odd_rows(spark):
    schema = "doc_id long, text string, runs string, n_words string, collapsed string"
    many = "w " * 30_000
    rows = [(1, None), (2, ""), (None, "a b " * 20), (3, "x " * 24), (4, "x " * 23), (4, "x " * 23), (5, many), (6, " \t\n"), (7, "q" * 200_000)]
    table = spark.createDataFrame([(*r, "k", "k", "k") for r in rows], schema)
    found = periodic_runs.periodic_runs(table).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in found}
    assert got[1, 0] == got[2, 0] == got[6, 0] == ([], "")
    assert got[None, 40] == ([(0, 40, 2)], "a b") and got[3, 24] == ([(0, 24, 1)], "x")
    assert got[4, 23] == ([], " ".join("x" * 23)) and got[5, 30_000] == ([(0, 30_000, 1)], "w") and got[7, 1][0] == []
    none = table.where("doc_id = 99")
    assert periodic_runs.periodic_runs(none).count() == 0
    edited = {r.doc_id: r.text for r in periodic_runs.repeated_tails(table).where("doc_id IS NULL OR doc_id < 4").collect()}
    assert edited[1] == "" and edited[None] == "a b " * 20


def test_best_run_ties(spark):
    runs = [(9, 30, 3), (5, 40, 4), (5, 20, 2), (7, 50, 5), (0, 28, 3)]
    row = spark.createDataFrame([(runs,)], "runs array<struct<start: bigint, length: bigint, period: bigint>>")
    assert tuple(row.select(periodic_runs.best_run(row["runs"])).first()[0]) == (5, 20, 2)


def test_query_equals_brute_force(spark):
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(table)
    some = 0
    for row in table:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words) if n < 3000 else None
        got = found[row.doc_id]
        if runs is None:
            continue
        some += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        assert got.n_runs == len(runs) and (got.start, got.length, got.period) == best
        assert got.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some
