"""Whitening against numpy's own solver and exact sums, and on the awkward tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components=4):
    """Rows of (id, vector) by component, from numpy."""
    kept = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for k, x in kept:
        whitened = (np.array(x) - mean) @ vectors / np.sqrt(values)
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out[k] = (n, deviation, whitened, values / np.trace(np.cov(fit.T, bias=True)))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    scales = np.array([3, 2, 1.5, 1.2, *[0.4] * 8])
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    found = (rng.standard_normal((300, 12)) * scales) @ turn
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(found)]
    rows += [(300 + i, rows[0][1]) for i in range(150)]  # one vector with a third of the rows
    nan, inf = float("nan"), float("inf")
    return rows + [(450, None), (451, [None] + [0.0] * 11), (452, [nan] + [0.0] * 11), (453, [-inf] + [0.0] * 11)]


def test_equals_plain_version(spark, vectors):
    frame = spark.createDataFrame([(k, v, 0) for k, v in vectors], SCHEMA).repartition(5)
    got = {}
    for r in whitening.whitened_components(frame).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    wanted = plain(vectors)
    assert set(got) == set(wanted) and all(sorted(g) == [1, 2, 3, 4] for g in got.values())
    signs = {c: math.copysign(1, got[0][c]["whitened"]) * math.copysign(1, wanted[0][2][c - 1]) for c in range(1, 5)}
    for k, (n, deviation, whitened, explained) in wanted.items():
        for c, r in got[k].items():
            assert (r["n"], r["deviation"]) == (n, deviation) and n == 300
            assert r["whitened"] * signs[c] == pytest.approx(whitened[c - 1], abs=1e-9)
            assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-10)
            assert r["identity_error"] < 1e-10


@pytest.mark.parametrize("d", [1, 2, 3, 5, 20, 64])
def test_leading_components(d):
    rng = np.random.default_rng(d)
    for case in range(6):
        a = rng.standard_normal((d, d))
        a = a @ a.T
        if case == 1:
            a = np.diag(rng.integers(0, 4, d).astype(float))  # ties, nothing off the diagonal
        elif case == 2:
            turn = np.linalg.qr(a)[0]
            a = turn @ np.diag([5.0, 5, 5, 5 - 1e-13, *[1] * d][:d]) @ turn.T  # a cluster
        elif case == 3:
            a = np.zeros((d, d))
        elif case == 4:
            a = np.ones((d, d))
        elif case == 5:
            a = np.kron(np.eye(2), a)[:d, :d] * 1e-9
        values, vectors = whitening.leading_components(a, 4)
        k = min(4, d)
        norm = max(np.linalg.norm(a), 1e-300)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-13 * norm, rtol=0)
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
        assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-12 * norm * d


def test_sturm_counts():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal(9), rng.standard_normal(8)
    values = np.linalg.eigvalsh(np.diag(a) + np.diag(b, 1) + np.diag(b, -1))
    shifts = np.linspace(-4, 4, 101)
    assert whitening.below(a, b, shifts).tolist() == [int((values < s).sum()) for s in shifts]


def test_odd_tables(spark):
    def count(rows, schema=SCHEMA):
        return whitening.whitened_components(spark.createDataFrame(rows, schema)).collect()

    assert count([]) == [] and count([(1, None, 0), (2, [], 0)]) == []
    assert count([(k, [1.0, 2.0], 0) for k in range(5)]) == []  # one vector: no scale
    two = count([(None, [1.0, 2.0], 0), (None, [2.0, 2.0], 0), (3, [1.0], 0), (4, [1.0, 2.0], 0)])
    assert [r["component"] for r in two] == [1, 1, 1] and {abs(r["whitened"]) for r in two} == {1.0}
    assert {r["explained"] for r in two} == {1.0}
    big = count([(1, [1e30, 0.0], 0), (2, [0.0, 1.0], 0), (3, [5.0, 0.5], 0)])
    assert {r["deviation"] for r in big} == {None} and {r["component"] for r in big} == {1}
    clash = "vec_id long, embedding array<double>, x int, c int, w0 int, whitened int, n int, i int, v int, component int"
    rows = [(k, [k / 3, -k * k / 7.0, 1.0], *[0] * 8) for k in range(6)]
    assert len(count(rows, clash)) == 12


def test_zero_is_zero(spark):
    rows = [(1, [-0.0, 1.0], 0), (2, [0.0, 1.0], 0), (3, [0.5, 0.25], 0)]
    assert {r["n"] for r in whitening.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()} == {2}


def test_no_vector_is_gathered(spark, vectors):
    frame = spark.createDataFrame([(k, v, 0) for k, v in vectors], SCHEMA)
    model = whitening.fit_whitening(frame)
    text = whitening.whiten(frame, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and model.n == 300
    assert whitening.whiten(frame, model).agg(F.count("*")).first()[0] == 450
