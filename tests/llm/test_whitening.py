import numpy as np
import pytest

from docferry.llm import whitening
from odd_data import CLASHING


def reference(vectors, k):
    """n, deviations, whitened values and explained shares, by numpy."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20))
    vectors[200:] = vectors[:100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    n, deviations, whitened, explained = reference(vectors, 16)
    rows = {(r.vec_id, r.component): r for r in whitening.whiten(df).collect()}
    assert len(rows) == 300 * 16
    assert {r.n for r in rows.values()} == {n}
    assert all(rows[i, 1].deviation == d for i, d in enumerate(deviations.tolist()))
    found = np.array([[rows[i, c + 1].whitened for c in range(16)] for i in range(300)])
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.allclose(found * signs, whitened, atol=1e-8)
    assert np.allclose([rows[0, c + 1].explained for c in range(16)], explained, rtol=1e-9)
    assert max(r.identity_error for r in rows.values()) < 1e-9


def test_scatter_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    a = np.random.default_rng(1).normal(size=(50, 3))
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "index long, v array<double>")
    matrix = whitening.block_matrix(rows.withColumn("v", whitening.array_to_vector("v")), "index", "v", 3)
    assert matrix.numRowBlocks == 8
    assert np.allclose(whitening.scatter(spark, matrix), a.T @ a)
    weights = np.array([[1.0, 0.0], [0.0, 2.0], [3.0, 0.0]])
    projected = {r["index"]: r.y for r in whitening.project(spark, matrix, weights).collect()}
    assert np.allclose([projected[i] for i in range(50)], a @ weights)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 2.0]), (2, [0.0, nan]), (3, None), (4, [None, 1.0]), (5, [inf, 0.0]), (6, [3.0]), (7, [0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in [*CLASHING, "x", "index", "y"])
    df = spark.createDataFrame([(*r, *("clash" for _ in range(len(CLASHING) + 3))) for r in rows], schema)
    found = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == sorted([(i, c) for i in (1, 1, 0, 6, 7) for c in (1, 2)])
    assert {r.n for r in found} == {4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(df).collect() == []


def test_components_without_variance_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [2.0, 5.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in whitening.whiten(df).collect()) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
