"""Whitening against numpy's own eigenvectors and exact arithmetic."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, "x", "y") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def whitened(spark, vectors, ids=None):
    df = frame(spark, vectors, ids)
    return whitening.transform(df, whitening.fit(df)).collect()


def expected(vectors):
    """Brute force: usable vectors, the distinct ones, exact deviations and the covariance by fractions."""
    usable = [(i, v) for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in usable}
    fit = sorted(set(whole.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    deviation = {i: sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for i, x in whole.items()}
    cov = np.array([[float(sum(Fraction(n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit) / n**3) for a in range(d)] for b in range(d)])
    return whole, n, sums, deviation, cov


def test_rows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in rng.standard_normal((120, 20)) * np.linspace(0.2, 3, 20)]
    vectors += [vectors[0]] * 60 + [None, [None] + vectors[1][1:], [float("nan")] + vectors[2][1:], [float("inf")] * 20]
    found = whitened(spark, vectors)
    whole, n, sums, deviation, cov = expected(vectors)
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1], directions[:, ::-1]
    by_component = {}
    assert len(found) == len(whole) * 16 and {r.vec_id for r in found} == set(whole)
    for r in found:
        k = r.component - 1
        centred = np.array([(n * x - s) / n for x, s in zip(whole[r.vec_id], sums)])
        value = centred @ directions[:, k] / math.sqrt(values[k])
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert abs(abs(r.whitened) - abs(value)) < 1e-9
        assert abs(r.explained - values[k] / np.trace(cov)) < 1e-12 and 0 <= r.identity_error < 1e-10
        by_component.setdefault(k, set()).add(round(math.copysign(1, r.whitened * value)) if abs(value) > 1e-6 else None)
    assert all(len(signs - {None}) == 1 for signs in by_component.values())


def test_equal_eigenvalues_missing_ranks_and_few_dimensions(spark):
    square = [[a, b, 7.0] for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    found = whitened(spark, square * 3)
    assert {r.component for r in found} == {1, 2} and len(found) == 24
    assert all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in found)
    for i in range(12):
        assert abs(sum(r.whitened**2 for r in found if r.vec_id == i) - 2) < 1e-12


def test_no_two_vectors_and_empty_tables(spark):
    assert whitened(spark, [[1.0, 2.0]] * 4) == []
    assert whitened(spark, [None, [float("nan")], []]) == []
    df = frame(spark, [[1.0]]).limit(0)
    assert whitening.transform(df, whitening.fit(df)).columns[:2] == ["vec_id", "component"]
    assert whitening.transform(df, whitening.fit(df)).count() == 0


def test_other_dimensions_null_ids_and_great_entries(spark):
    vectors = [[1.0, 0.0], [0.0, 2.0], [3.0, 1e30], [-1.0, -1e30], [5.0], [1.0, 0.0]]
    found = whitened(spark, vectors, ids=[None, 1, 2, 3, 4, None])
    assert {r.vec_id for r in found} == {None, 1, 2, 3}
    assert sum(r.vec_id is None for r in found) == 2 * len({r.component for r in found})
    assert all(r.n == 4 and math.isfinite(r.whitened) for r in found)
    assert all(r.deviation is None for r in found if r.vec_id == 3)


@pytest.mark.parametrize("d", [1, 2, 7, 33])
def test_inertia_counts_and_leading_values(d):
    rng = np.random.default_rng(d)
    for matrix in (rng.standard_normal((d, d)), np.ones((d, d)), np.diag(np.arange(d) // 2 * 1.0), np.zeros((d, d))):
        matrix = matrix + matrix.T
        truth = np.linalg.eigvalsh(matrix)
        for shift in (-1.234, 0.1234, 2.345):
            assert whitening.above(matrix, shift) == (truth > shift).sum()
        positive = matrix @ matrix
        values, vectors = whitening.leading(positive, 16)
        truth = np.linalg.eigvalsh(positive)[::-1]
        size = max(truth[0], 1e-300)
        assert np.allclose(values, truth[: len(values)], atol=1e-13 * size, rtol=0)
        assert np.abs(positive @ vectors.T - vectors.T * values).max(initial=0) < 1e-12 * size
        assert len(values) == min(16, (truth > 1e-10 * size).sum())


def test_near_eigenvalues_are_told_apart():
    rng = np.random.default_rng(2)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    truth = np.concatenate([[5, 5 - 1e-9, 5 - 2e-9, 4, 4, 4], np.linspace(3, 0.1, 24)])
    values, vectors = whitening.leading(basis @ np.diag(truth) @ basis.T)
    assert np.allclose(values, truth[:16], atol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(16), atol=1e-12)


def test_nearly_equal_eigenvalues_of_many_vectors():
    """Vectors in no preferred direction: the more there are, the nearer the eigenvalues; some lie beside a slice's edge."""
    for seed in range(12):
        noise = np.random.default_rng(seed).standard_normal((64, 64))
        matrix = 64 * (np.eye(64) + (noise + noise.T) / math.sqrt(2 * 3e6))
        values, vectors = whitening.leading(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:16], atol=1e-11, rtol=0)
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11
        assert np.allclose(vectors @ vectors.T, np.eye(16), atol=1e-12)


def test_rows_of_nearly_equal_eigenvalues(spark):
    lengths = sorted(np.random.default_rng(0).choice(np.arange(100_000, 100_400), 16, replace=False).tolist())
    vectors = [[sign * a / 64 if i == at else 0.0 for i in range(16)] for at, a in enumerate(lengths) for sign in (1, -1)]
    found = whitened(spark, vectors)
    trace = sum(a * a for a in lengths)
    assert len(found) == 32 * 16 and all(r.identity_error < 1e-10 for r in found)
    for r in found:
        own = 16 - r.component == r.vec_id // 2
        assert abs(abs(r.whitened) - (4.0 if own else 0.0)) < 1e-9
        assert abs(r.explained - lengths[-r.component] ** 2 / trace) < 1e-12
