"""Whitening against numpy's eigenvalues and exact integers, over odd and empty tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import whitening
from shelfmark.llm.queries import queries


def brute(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], axes[:, ::-1]


def test_against_numpy(spark, small_dir):
    rows = pq.read_table(f"{small_dir}/embeddings.parquet").to_pandas()
    deviation, centred, values, axes = brute(rows.embedding)
    found = queries()["op12_whitening"](spark, small_dir).toPandas()
    assert len(found) == 32 * len(rows) and set(found.component) == set(range(1, 33)) and set(found.n) == {len(rows)}
    expected = dict(zip(rows.vec_id, deviation))
    assert all(expected[i] == d for i, d in zip(found.vec_id, found.deviation))
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    place = {v: i for i, v in enumerate(rows.vec_id)}
    for component, own in found.groupby("component"):
        assert np.allclose(own.explained, values[component - 1] / values.sum(), rtol=1e-10)
        exact = (centred @ axes[:, component - 1] / np.sqrt(values[component - 1]))[[place[v] for v in own.vec_id]]
        sign = np.sign((exact * own.whitened).sum())
        assert np.allclose(own.whitened, sign * exact, atol=1e-8)


def test_odd_vectors(spark, odd_dir):
    """Null, null entry, NaN, infinity and other lengths are left out; repeated ids stay; huge entries do not break."""
    found = queries()["op12_whitening"](spark, odd_dir).collect()
    ids = sorted((r.vec_id is None, r.vec_id or 0) for r in found if r.component == 1)
    assert ids == sorted([(False, i) for i in (1, 2, 2, 3, 4, 7, 12, 13)] + [(True, 0)])
    assert {r.n for r in found} == {9} and {r.component for r in found} == {1, 2}
    # 2^52 x 9 squared does not fit 64 bits.
    assert all(r.deviation is None for r in found)


def test_exact_deviations(spark):
    rows = [(i, [float(i % 5), 0.5 * i, -1.25]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    deviation, *_ = brute([v for _, v in rows])
    found = {r.vec_id: r for r in whitening.whiten(frame).collect() if r.component == 1}
    assert [found[i].deviation for i in range(40)] == list(deviation)
    # The third dimension never varies, so there are two components.
    assert whitening.whiten(frame).agg(F.max("component")).first()[0] == 2


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]], [None]])
def test_nothing_to_whiten(spark, vectors):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    assert whitening.whiten(frame).count() == 0


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 3, 4.0), (2, [0.0, 3.0], 5, 6.0)], "vec_id long, embedding array<double>, x long, p double")
    assert whitening.whiten(frame).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_jacobi_keeps_small_eigenvalues():
    """A graded spectrum over twelve orders of magnitude, to a relative accuracy eigh of the covariance misses."""
    rng = np.random.default_rng(5)
    scales = 10.0 ** -np.arange(0, 12)
    axes = np.eye(12) + 1e-3 * rng.standard_normal((12, 12))
    factor = axes * scales
    covariance = factor @ factor.T
    low = whitening.pivoted_cholesky(covariance)
    assert np.allclose(low @ low.T, covariance, rtol=1e-12, atol=1e-30)
    values, vectors = whitening.eigen(np.diag(scales[:7]))
    assert np.allclose(values, scales[:7], rtol=1e-13) and np.allclose(np.abs(vectors), np.eye(7), atol=1e-12)


def test_equal_eigenvalues_and_rank():
    values, vectors = whitening.eigen(2 * np.eye(5))
    assert np.allclose(values, 2) and np.allclose(vectors.T @ vectors, np.eye(5))
    ones = np.ones((4, 4))
    values, vectors = whitening.eigen(ones)
    assert np.allclose(values, [4]) and np.allclose(vectors[:, 0], 0.5)
