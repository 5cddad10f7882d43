"""Whitening against LAPACK and exact whole-number sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsline.llm import whitening as W
from oddsline.llm.queries import QUERIES
from tests.conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int"
RNG = np.random.default_rng(5)


def matrices():
    yield RNG.normal(size=(300, 24))
    yield RNG.normal(size=(300, 24)) * np.logspace(0, -7, 24)
    yield RNG.normal(size=(60, 4)) @ RNG.normal(size=(4, 15))
    yield np.vstack([np.diag([1.0] * 4 + [2.0] * 3 + [0.0] * 2)] * 2)
    yield np.diag(np.r_[1:11, 11, 10:0:-1] + 20.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield RNG.integers(0, 3, size=(9, 1)).astype(float)
    yield RNG.integers(-2, 3, size=(5, 11)).astype(float)


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: "x".join(map(str, a.shape)))
def test_decomposition(a):
    values, v = W.decomposed(np.linalg.qr(a, mode="r"))
    want = np.linalg.svd(a, compute_uv=False)
    want = want[want > want[0] * 1e-10]
    np.testing.assert_allclose(values, want, rtol=1e-8)
    np.testing.assert_allclose(v.T @ v, np.eye(len(values)), atol=1e-11)
    np.testing.assert_allclose(a.T @ a @ v, v * values ** 2, atol=1e-11 * want[0] ** 2)


def test_relative_accuracy_of_small_values():
    # A bidiagonal with tiny values: its determinant is the product of the diagonal.
    diagonal, above = np.logspace(0, -100, 12), np.logspace(0, -90, 11)
    squares = W.dqds(diagonal, above)
    assert math.isclose(np.log(squares).sum(), 2 * np.log(diagonal).sum(), rel_tol=1e-13)
    assert (np.diff(squares) <= 0).all()


def test_no_variance():
    for a in (np.zeros((3, 4)), np.empty((0, 4))):
        values, v = W.decomposed(a)
        assert len(values) == 0 and v.shape == (4, 0)


def brute(vectors, components=16):
    """(key, component) to the row, by numpy's eigenvalues and whole numbers of any size."""
    rows = [(k, [math.floor(64 * float(c)) + 1000000 for c in v]) for k, v in vectors]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    used = min(components, int((e > e[0] * 1e-18).sum()))
    out = []
    for k, x in rows:
        scaled = [n * a - s for a, s in zip(x, sums)]
        white = np.array(scaled, float) / n @ v[:, :used] / np.sqrt(e[:used])
        out += [(k, i + 1, n, sum(a * a for a in scaled), white[i], e[i] / e.sum()) for i in range(used)]
    return out


def same(got, want):
    """Equal but for rounding and one sign per component."""
    order = lambda r: (r[1], r[0] is not None, r[0] or 0, r[3], abs(round(r[4], 6)))
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for c in {w[1] for w in want}:
        a = np.array([g[4] for g in got if g[1] == c])
        b = np.array([w[4] for w in want if w[1] == c])
        np.testing.assert_allclose(a, b * np.sign(a @ b), atol=1e-7)
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_query(spark):
    rows = [tuple(r) for r in QUERIES["op12_embedding_whitening"](spark, f"{DATA}/sf0.01").collect()]
    vectors = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    assert len(rows) == 16 * len(vectors) and all(0 <= r[6] < 1e-9 for r in rows)
    same(rows, brute([tuple(r) for r in vectors]))


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA).repartition(5)


def test_edge_rows(spark):
    good = [(i, RNG.normal(size=5).round(3).tolist()) for i in range(60)]
    good += [good[0], (99, good[0][1]), (None, good[1][1]), (None, good[1][1])]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5),
           (104, [float("-inf"), 0.0, 0.0, 0.0, 0.0]), (105, []), (106, [1.0]), (107, [3e38] * 5)]
    vectors = frame(spark, good + bad).withColumns({c: F.lit("clash") for c in ("x", "n", "component", "_all")})
    rows = [tuple(r) for r in W.whitened(vectors).collect()]
    floats = [(k, np.array(v, np.float32)) for k, v in good]
    assert len(rows) == 5 * len(good) and rows[0][6] < 1e-9
    same(rows, brute(floats))


def test_fewer_components_and_merging(spark, monkeypatch):
    monkeypatch.setattr(W, "MERGED", 2)
    good = [(i, RNG.normal(size=6).tolist()) for i in range(90)]
    rows = [tuple(r) for r in W.whitened(frame(spark, good).repartition(9), components=3).collect()]
    same(rows, brute([(k, np.array(v, np.float32)) for k, v in good], 3))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_components(spark, rows):
    got = W.whitened(frame(spark, rows))
    assert got.count() == 0
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]


def test_constant_dimension_and_two_vectors(spark):
    good = [(1, [1.0, 2.0, 5.0]), (2, [3.0, 2.0, 5.0])]
    got = [tuple(r) for r in W.whitened(frame(spark, good)).collect()]
    assert sorted((r[0], r[1], r[2], r[3]) for r in got) == [(1, 1, 2, 128 ** 2), (2, 1, 2, 128 ** 2)]
    assert sorted(round(r[4], 9) for r in got) == [-1.0, 1.0] and got[0][5] == pytest.approx(1.0)


def test_deviation_beyond_a_long(spark):
    good = [(i, [float(i * 2 ** 20)] * 3) for i in range(30)]
    got = {(r["vec_id"], r["component"]): r["deviation"] for r in W.whitened(frame(spark, good)).collect()}
    x = [[64 * i * 2 ** 20 + 1000000] * 3 for i in range(30)]
    total = sum(v[0] for v in x)
    for i in range(30):
        exact = 3 * (30 * x[i][0] - total) ** 2
        assert got[i, 1] == (exact if exact < 2 ** 63 else None)
    assert None in got.values() and any(v is not None for v in got.values())
