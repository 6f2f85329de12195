"""Whitening against numpy's eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from annospark.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, vector int, n int, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def plain(vectors):
    """(rows as integers, whitened up to sign, shares, exact deviations) of usable vectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [[n * a - s for a, s in zip(row, sums)] for row in x]
    a = np.array(dev, float) / n
    values, u = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)
    return n, [sum(d * d for d in row) for row in dev], a @ (u[:, order] / np.sqrt(np.maximum(values[order], 1e-300))), values[order] / values.sum()


def test_coordinates_equal_those_of_eigenvectors(spark):
    rng = np.random.default_rng(5)
    good = (rng.standard_normal((300, 12)) * np.geomspace(3, 0.02, 12) + 2).tolist()
    odd = [None, [], [1.0] * 11, [None] + [0.5] * 11, [float("nan")] + [0.5] * 11, [float("inf")] + [0.5] * 11, [1.0] * 13]
    rows = [(i, v) for i, v in enumerate(good)] + [(1000 + i, v) for i, v in enumerate(odd)] + [(7, good[3]), (None, good[3])]
    table = frame(spark, rows).repartition(5)
    model = w.fit(table)
    n, deviation, z, share = plain([*good, good[3], good[3]])
    assert model.n == n and len(model.eigenvalues) == 12
    assert np.allclose(model.eigenvalues / model.trace, share, rtol=1e-9)
    assert np.allclose(model.directions @ model.directions.T, np.eye(12), atol=1e-12)
    assert w.identity_error(table, model, 8) < 1e-9
    found = {(r.vec_id, tuple(r.whitened)): r for r in w.whiten(table, model, 8).collect()}
    by_id = {k[0]: r for k, r in found.items() if k[0] not in (7, None)}
    assert sorted(by_id) == sorted(set(range(300)) - {7})
    sign = np.sign([by_id[0].whitened[k] * z[0][k] for k in range(8)])
    for i, r in by_id.items():
        assert r.deviation == deviation[i]
        assert np.allclose(np.array(r.whitened) * sign, z[i][:8], atol=1e-8)
    assert sum(1 for k in found if k[0] == 7) == 2 and sum(1 for k in found if k[0] is None) == 1


def test_ill_conditioned_and_deficient_rows_are_orthogonalised(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((400, 3)) * [900.0, 1.0, 0.01]
    rows = [(i, [a, b, c, a, 5.0, 2 * b]) for i, (a, b, c) in enumerate(base.tolist())]  # one copy, one constant, one multiple
    table = frame(spark, rows).repartition(3)
    model = w.fit(table)
    assert 3 <= len(model.eigenvalues) <= 5
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float))
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert np.allclose(model.eigenvalues[:3], values[:3], rtol=1e-7)
    assert w.identity_error(table, model, 3) < 1e-6


def test_triangular_solves_and_gram_passes_give_orthogonal_rows():
    rng = np.random.default_rng(7)
    a = rng.standard_normal((500, 6)) * np.geomspace(1, 1e-7, 6)
    factors = []
    for _ in range(w.PASSES):
        q = w.solved(a.copy(), factors)
        factors.append(w._factor(q.T @ q, 1e-13 * np.linalg.norm(q.T @ q, 2) if not factors else 0.0))
    q = w.solved(a.copy(), factors)
    assert np.abs(q.T @ q - np.eye(6)).max() < 1e-12
    r = factors[2] @ factors[1] @ factors[0]
    assert np.allclose(np.triu(r), r) and np.allclose(r.T @ r, a.T @ a, rtol=1e-6, atol=1e-16)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_a_direction_there_are_no_coordinates(spark, rows):
    table = frame(spark, rows)
    model = w.fit(table)
    assert len(model.eigenvalues) == 0 and w.identity_error(table, model, 8) == 0
    assert [r.whitened for r in w.whiten(table, model).collect()] == [[] for _, v in rows if v]


def test_far_entries_stay_exact_or_null(spark):
    x = np.array([[1 << 52, 0], [5, 7], [-(1 << 52), 1]], np.int64)
    sums = tuple(w._column_sums(x))
    assert sums == (5, 8) and w._column_sums(-x) == [-5, -8]
    dev = w.deviations(x, 3, sums)
    assert [[int(v) for v in row] for row in dev] == [[3 * (1 << 52) - 5, -8], [10, 13], [-3 * (1 << 52) - 5, -5]]
    assert w.squared_lengths(dev) == [None, 269, None]
    table = frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 2.0])])
    assert {r.vec_id: r.deviation is None for r in w.whiten(table, w.fit(table)).collect()} == {1: True, 2: True, 3: True}


def test_query_has_a_row_per_vector_and_component(spark, tmp_path):
    rng = np.random.default_rng(8)
    spark.createDataFrame([(i, v) for i, v in enumerate(rng.standard_normal((50, 5)).tolist())] + [(99, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = w.op11_whitening(spark, str(tmp_path)).collect()
    assert sorted((r.vec_id, r.component) for r in rows) == [(i, c) for i in range(50) for c in range(1, 6)]
    assert {r.n for r in rows} == {50} and max(r.identity_error for r in rows) < 1e-9 and abs(sum(r.explained for r in rows if r.vec_id == 0) - 1) < 1e-9
