"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from hirelens.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, id long, x string, block int, v string, component int, n int"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "a", 2, "b", 3, 4) for i, v in rows], SCHEMA).repartition(parts)


def _taken(rows):
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) and abs(64 * c) <= 2**50 for c in v):
            out.append((i, [math.floor(64 * c) + 1_000_000 for c in v]))
    width = max((len(x) for _, x in out), default=0)
    return [(i, x + [1_000_000] * (width - len(x))) for i, x in out]


def _check(got, rows, k):
    taken = _taken(rows)
    fit = np.array(sorted({tuple(x) for _, x in taken}))
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    c -= c.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == k * len(taken)
    left = {}
    for r in got:
        left.setdefault((r.id, r.deviation), []).append(r)
    for i, x in taken:
        dev = sum((n * a - int(b)) ** 2 for a, b in zip(x, s))
        own = sorted(left[(i, dev)], key=lambda r: r.component)
        for j, r in enumerate(own[:: len(own) // k]):
            assert r.n == n and r.component == j + 1
            assert r.explained == pytest.approx(values[j] / values.sum(), rel=1e-10)
            assert abs(r.whitened) == pytest.approx(abs((np.array(x) - s / n) @ vectors[:, j]) / math.sqrt(values[j]), rel=1e-6, abs=1e-7)
            assert r.identity_error < 1e-10 and r.residual <= 100 * 2**-52 * values[0]


def test_whitening_matches_dense(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(24, 24))
    rows = [(k, [float(c) for c in rng.normal(size=24) * np.linspace(3, 0.2, 24) @ mix / 5]) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)] + [rows[3], rows[3], (None, rows[4][1])]
    rows += [(2000, None), (2001, [None] * 24), (2002, [float("nan")] + [0.0] * 23), (2003, [float("inf")] + [0.0] * 23), (2004, [1e300] * 24),
             (2005, [0.25] * 20), (2006, [])]
    _check(whitening.whiten(_frame(spark, rows), 16).collect(), rows, 16)


def test_whitening_of_few_and_no_directions(spark):
    line = [(k, [0.5 * k, 1.0 * k, 3.0]) for k in range(9)]
    _check(whitening.whiten(_frame(spark, line), 16).collect(), line, 16)
    assert whitening.whiten(_frame(spark, [(k, [1.0, 2.0]) for k in range(5)])).collect() == []
    for none in ([], [(1, None)], [(1, []), (2, [])]):
        assert whitening.whiten(_frame(spark, none)).collect() == []
    large = [(k, [1e12 * (k % 3 + 1), 2e12 * k]) for k in range(5)]
    assert {int(r.deviation) for r in whitening.whiten(_frame(spark, large)).collect()} == {
        sum((5 * a - b) ** 2 for a, b in zip(x, [sum(c) for c in zip(*[y for _, y in _taken(large)])])) for _, x in _taken(large)}


def test_jacobi_davidson_restarts_locks_and_keeps_order():
    rng = np.random.default_rng(8)
    q, _ = np.linalg.qr(rng.normal(size=(300, 300)))
    values = np.concatenate([[50, 50, 50, 20, 19.999, 19.998], np.linspace(15, 0, 294)])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    passes = []
    e, v, residual = whitening.jacobi_davidson(lambda u: passes.append(u.shape[1]) or a @ u, 300, 6)
    assert np.allclose(e, values[:6], rtol=1e-12) and np.abs(v.T @ v - np.eye(6)).max() < 1e-12
    assert residual.max() <= 2 * 300 * 2**-52 * 50 and len(passes) < 200
    e, _, _ = whitening.jacobi_davidson(lambda u: 0 * u, 5, 3)
    assert np.all(e == 0)


def test_minres_solves_columns():
    rng = np.random.default_rng(2)
    m = rng.normal(size=(30, 30))
    m = m + m.T
    b = rng.normal(size=(30, 4))
    assert np.allclose(whitening.minres(lambda x: m @ x, b, 200, 1e-13), np.linalg.solve(m, b), rtol=1e-6, atol=1e-7)
