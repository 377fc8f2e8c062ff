"""Whitening against a symmetric eigensolver, and exact sums against Python integers."""

import numpy as np
import pytest

from tidewatch.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain(rows, components=4):
    x = {i: [int(np.floor(256 * np.float64(c))) for c in v] for i, v in rows}
    once = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(once), [int(s) for s in once.sum(axis=0)]
    values, vectors = np.linalg.eigh(np.cov(once.T, bias=True))
    return x, n, sums, values[::-1], vectors[:, ::-1]


def test_query_equals_an_eigensolver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x, n, sums, values, vectors = plain(rows)
    found = queries.op12_whitening(spark, SF).collect()
    assert len(found) == 4 * len(rows) and {r.n for r in found} == {n}
    assert max(r.identity_error for r in found) < 1e-10
    for c in range(1, 5):
        mine = {r.vec_id: r for r in found if r.component == c}
        want = {i: float((np.array(v) - np.array(sums) / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1])) for i, v in x.items()}
        sign = np.sign(mine[rows[0][0]].whitened * want[rows[0][0]])
        assert all(abs(mine[i].whitened - sign * want[i]) < 1e-8 for i in x)
        assert all(mine[i].deviation == sum((n * e - s) ** 2 for e, s in zip(v, sums)) for i, v in x.items())
        assert abs(mine[rows[0][0]].explained - values[c - 1] / values.sum()) < 1e-12


@pytest.mark.parametrize("rank", [1, 3, 8])
def test_factor_and_rotations(rank):
    dice = np.random.default_rng(rank)
    part = dice.normal(size=(8, rank)) * 10.0 ** dice.integers(-2, 3, rank)
    matrix = part @ part.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (8, rank) and np.allclose(factor @ factor.T, matrix)
    pivots = [int(np.argmax(np.abs(factor[:, 0])))]
    assert matrix[pivots[0], pivots[0]] == matrix.diagonal().max()
    values, vectors = whitening.one_sided_jacobi(factor)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank]) and np.allclose(vectors * values @ vectors.T, matrix)


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>, x string, at string, component string"
    dice = np.random.default_rng(2)
    good = [(i, [float(c) for c in dice.normal(size=5)]) for i in range(40)]
    odd = [(None, good[0][1]), (50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("inf")] * 5), (54, []), (55, [1.0]), (3, good[3][1])]
    table = spark.createDataFrame([(*r, "k", "k", "k") for r in good + odd], schema)
    found = whitening.whitened(table).collect()
    assert len(found) == 4 * 42 and {r.n for r in found} == {40}
    assert {r.vec_id for r in found} == {None, *range(40)} and max(r.identity_error for r in found) < 1e-10
    twins = {r.component: r.whitened for r in found if r.vec_id is None}
    assert twins == {r.component: r.whitened for r in found if r.vec_id == 0}
    for none in (table.where("vec_id = 99"), table.where("vec_id = 50"), table.where("vec_id = 7"), table.where("vec_id = 54")):
        assert whitening.whitened(none).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(10)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whitened(flat).collect()} == {1}


def test_large_entries_stay_exact(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [3e15, -4.0]), (3, [0.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.deviation for r in whitening.whitened(table).collect()}
    assert found == {0: None, 1: None, 2: None, 3: None}
    rows = [(i, [2.0**20 * i, 1.0 * i]) for i in range(4)]
    found = {r.vec_id: r.deviation for r in whitening.whitened(spark.createDataFrame(rows, table.schema)).collect()}
    assert found[0] == (4 * 0 - 6 * 2**28) ** 2 + (6 * 256) ** 2
