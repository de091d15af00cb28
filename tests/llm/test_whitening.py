"""Whitening against numpy's eigenvectors of the exact covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from subsidia.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, whitened string, deviation string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "n", "w", "d", "c") for i, v in vectors], SCHEMA)


def exact_covariance(x):
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    apart = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    return sums, apart, np.array([[float(Fraction(sum(r[i] * r[j] for r in apart), n**3)) for j in range(d)] for i in range(d)])


def check(spark, vectors, good, most):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good]
    sums, apart, v = exact_covariance(x)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(most, int((values > values[0] * 1e-10).sum()))
    got = whitening.whitened_components(table(spark, vectors), most).collect()
    assert len(got) == rank * len(good)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    for k in range(rank):
        rows = sorted(by[k + 1], key=lambda r: (-1 if r["vec_id"] is None else r["vec_id"]))
        order = sorted(range(len(good)), key=lambda i: (-1 if good[i][0] is None else good[i][0]))
        assert [r["vec_id"] for r in rows] == [good[i][0] for i in order]
        assert [int(r["deviation"]) for r in rows] == [sum(a * a for a in apart[i]) for i in order]
        w = np.array([r["whitened"] for r in rows])
        want = (np.array(apart, float)[order] / len(good)) @ axes[:, k] / math.sqrt(values[k])
        if k + 1 == len(values) or abs(values[k] - values[k + 1]) > 1e-6 * values[0] < abs(values[k] - values[k - 1]):
            assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-7
        assert all(r["n"] == len(good) and abs(r["explained"] - values[k] / np.trace(v)) < 1e-9 and r["identity_error"] < 1e-6 for r in rows)


@pytest.mark.parametrize("n, d, most", [(300, 12, 5), (40, 64, 32), (9, 16, 32), (200, 3, 32)])
def test_equals_eigenvectors(spark, n, d, most):
    rng = np.random.default_rng(n)
    scale = np.geomspace(1, 20, d)
    good = [(i, [float(c) for c in rng.standard_normal(d) * scale]) for i in range(n)]
    good += [(5, good[5][1]), (None, good[6][1])]
    bad = [(900, None), (901, [1.0] * (d - 1) + [None]), (902, [float("nan")] * d), (903, [float("inf")] + [0.0] * (d - 1)), (904, [1.0] * (d + 1)), (905, [])]
    check(spark, good + bad, good, most)


def test_equal_eigenvalues(spark):
    corners = [(i, [(-1.0 if i >> j & 1 else 1.0) for j in range(6)]) for i in range(64)]
    check(spark, corners, corners, 4)
    rows = whitening.whitened_components(table(spark, corners), 4)
    assert rows.count() == 4 * 64 and rows.filter("abs(explained - 1 / 6D) > 1e-9 or identity_error > 1e-9").count() == 0


def test_nothing_to_whiten(spark):
    assert whitening.whitened_components(table(spark, [])).count() == 0
    assert whitening.whitened_components(table(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whitened_components(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_large_deviations_stay_exact(spark):
    rng = random.Random(2)
    good = [(i, [float(rng.randint(-(2**24), 2**24)) * 256 for _ in range(3)]) for i in range(50)]
    check(spark, good, good, 3)


def test_intervals_and_filter():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for values in (rng.uniform(0, 1, 40), np.repeat([1.0, 2.0, 3.0, 5.0], 10), np.r_[np.full(39, 1e-9), 1.0], 1 + rng.uniform(0, 1e-4, 40)):
        a = (q * values) @ q.T
        inertia = whitening.Inertia((a + a.T) / 2)
        for shift in (0.5, 1.5, 4.0):
            assert inertia.below(shift) == (values < shift).sum()
        found = []
        for lo, hi, n in inertia.intervals(25):
            got, vectors = whitening.eigenpairs((a + a.T) / 2, lo, hi, n)
            assert np.abs(vectors @ a - got[:, None] * vectors).max() < 1e-11 * np.abs(values).max() * 40
            found += got.tolist()
        assert len(found) >= 25 and np.allclose(sorted(found, reverse=True)[:25], sorted(values, reverse=True)[:25], rtol=0, atol=1e-11)
