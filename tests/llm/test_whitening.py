"""Embedding whitening against a plain eigendecomposition."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from brute import clashing, empty

from ledgerloom.llm import whitening

VECS = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """Whole numbers, the fit list, and its eigenpairs by numpy."""
    x = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:components] > 1e-12 * values[0]).sum())
    out = {}
    for i, v in x:
        own = np.array([(n * c - s) / n for c, s in zip(v, sums)])
        out[i] = sum((n * c - s) ** 2 for c, s in zip(v, sums)), own @ vectors[:, :k] / np.sqrt(values[:k])
    return n, values[:k] / values.sum(), out


def check(got, rows, components=16):
    n, explained, want = brute(rows, components)
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, len(explained) + 1))
    for k, held in by.items():
        assert sorted(r.vec_id for r in held) == sorted(i for i, _ in rows)
        turned = np.array([r.whitened for r in held]), np.array([want[r.vec_id][1][k - 1] for r in held])
        sign = np.sign(turned[0] @ turned[1])
        assert np.allclose(turned[0], sign * turned[1], rtol=1e-6, atol=1e-7)
        assert all(abs(r.explained - explained[k - 1]) <= 1e-9 * explained[k - 1] and r.n == n and r.deviation == want[r.vec_id][0] for r in held)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def vectors(n=300, d=12, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) @ r.normal(size=(d, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("d", [3, 12, 24])
def test_whitening_equals_a_plain_decomposition(spark, d):
    rows = vectors(d=d) + [(1000 + k, vectors(d=d)[0][1]) for k in range(90)] + [(5000, [0.0] * d)] * 2
    bad = [(2000, None), (2001, []), (2002, [1.0] * (d - 1) + [None]), (2003, [float("nan")] * d), (2004, [float("inf")] + [0.0] * (d - 1)), (2005, [1.0] * (d + 1)), (2006, [3e38] * d)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows[:200] + bad + rows[200:]], VECS).repartition(6)
    rows = [(i, v) for i, v in rows if i != 5000] + [(5000, [0.0] * d)]
    got = whitening.whiten(clashing(df).withColumnRenamed("x", "x2")).collect()
    assert sum(r.vec_id == 5000 for r in got) == 2 * min(16, d)
    once, seen = [], set()
    for r in got:
        if (r.vec_id, r.component) not in seen:
            seen.add((r.vec_id, r.component))
            once.append(r)
    check(once, rows)


def test_equal_eigenvalues_low_rank_and_large_offsets(spark):
    r = random.Random(2)
    corners = [[1000.0 + s * (k == j) for j in range(4)] for k in range(4) for s in (-1, 1)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(corners)], VECS)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and {round(r.explained, 12) for r in got} == {0.25} and got[0].identity_error < 1e-10
    flat = [(i, [(t := r.randint(-50, 50)) / 64, 2 * t / 64, (u := r.randint(-50, 50)) / 64, (t + u) / 64, 0.25]) for i in range(60)]
    check(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in flat], VECS).repartition(4)).collect(), flat)


def test_null_ids_and_tables_without_spread(spark):
    assert whitening.whiten(empty(spark, VECS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], VECS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECS)).count() == 0
    got = whitening.whiten(spark.createDataFrame([(None, [1.0], 0), (2, [2.0], 0)], VECS)).collect()
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation, abs(round(r.whitened, 12)), r.explained) for r in got) == [("2", 1, 2, 4096, 1.0, 1.0), ("None", 1, 2, 4096, 1.0, 1.0)]


def test_deviations_beyond_a_long_are_null():
    centre = whitening.Centre(1 << 33, [(1 << 33) * 5, 7])
    assert centre.deviations(np.array([[5, 0], [1 << 20, 0]])) == [49, None]


@pytest.mark.parametrize("seed", range(6))
def test_rank_one_updates_and_merges(seed):
    r = np.random.default_rng(seed)
    d, n = int(r.integers(1, 20)), int(r.integers(1, 120))
    x = [r.normal(size=(n, d)) * 10.0 ** r.integers(-3, 4, d), np.eye(d)[r.integers(0, d, n)], r.integers(-1, 2, (n, d)).astype(float)][seed % 3]
    a, b = whitening.Spectrum(d), whitening.Spectrum(d)
    for k, v in enumerate(x):
        (a if k % 2 else b).add(v)
    a.merge(b.values, b.vectors)
    whole = x.T @ x
    assert np.allclose(a.values, np.linalg.eigvalsh(whole), atol=1e-12 * max(1, np.abs(whole).max()))
    assert np.allclose(a.vectors.T @ a.vectors, np.eye(d), atol=1e-12)
    assert np.allclose(a.vectors * a.values @ a.vectors.T, whole, atol=1e-11 * max(1, np.abs(whole).max()))
    assert (np.diff(a.values) >= 0).all()
