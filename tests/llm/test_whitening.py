from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from precis.llm import whitening

EXTRA = "x string, n int, component int, copies int, at int, value int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1, 1, 1, 1) for r in rows], f"vec_id long, embedding array<double>, {EXTRA}").repartition(3)


def run(spark, rows, **settings):
    return sorted((tuple(r) for r in whitening.whiten(table(spark, rows), **settings).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def whole(v, size):
    return [int(np.floor(64 * c)) + 1_000_000 for c in v] + [1_000_000] * (size - len(v))


def _long(v):
    return v if v < 2**63 else None


def check(got, rows, size, most=16):
    """Against an eigendecomposition of the covariance of exactly centred rows."""
    good = [(k, whole(v, size)) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    a = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, total, strict=True)] for x in fit])
    values = np.linalg.svd(a, compute_uv=False) ** 2 / n
    rank = min(int((values > 1e-18 * values[0]).sum()), most)
    assert len(got) == len(good) * rank
    exact = sorted(((k, _long(sum((n * c - s) ** 2 for c, s in zip(x, total, strict=True)))) for k, x in good), key=lambda t: (t[0] is None, t[0] or 0))
    assert {(r[0], r[3]) for r in got} == set(exact)
    for row in got:
        assert row[2] == n and row[6] <= 1e-4
        assert row[5] == pytest.approx(values[row[1] - 1] / values.sum(), rel=1e-6)
    return rank


def test_equals_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 24)) * np.linspace(1, 9, 24) @ rng.normal(size=(24, 24))
    rows = [(i, r) for i, r in enumerate(v.tolist())]
    got = run(spark, rows)
    assert check(got, rows, 24) == 16
    x = np.array([whole(r, 24) for r in v])
    a = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(a.T @ a / len(a))
    for component in range(1, 17):
        own = np.array([r[4] for r in got if r[1] == component])
        want = a @ vectors[:, -component] / np.sqrt(values[-component])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-7


def test_badly_scaled_directions_keep_their_accuracy(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 5))
    v[:, 1] = v[:, 0] + v[:, 1] * 1e-1
    v *= [1e8, 1e8, 1e4, 1e2, 1.0]
    rows = [(i, r) for i, r in enumerate(v.tolist())]
    assert check(run(spark, rows), rows, 5) == 5


def test_odd_rows_copies_and_dependent_dimensions(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [0.5, 1.0]), (3, []), (4, None), (5, [None, 1.0, 1.0]), (6, [float("nan")]),
        (7, [float("-inf"), 0.0]), (None, [7.0, 0.5, -2.0]), *((i, [4.0, 4.0, 4.0]) for i in range(20, 60)), (8, [1.0, -1.0, 0.0]),
    ]
    assert check(run(spark, rows), rows, 3) == 3
    twice = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i % 3)]) for i in range(60)]
    assert check(run(spark, twice), twice, 4) == 2
    wide = [(i, [float((i * j) % 11) for j in range(1, 30)]) for i in range(6)]
    assert check(run(spark, wide), wide, 29) == 5
    assert check(run(spark, wide, most=3), wide, 29, 3) == 3


def test_one_vector_or_none(spark):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, []) == []


def test_deviation_beyond_a_long_is_null():
    w = whitening._deviations(np.array([[2**40, 0], [1, 1]]), 2**20, np.array([0, 0]))
    assert w == [None, 2 * 2**40]
