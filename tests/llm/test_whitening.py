from __future__ import annotations

import math

import numpy as np
import pytest

from larder.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, vector string, size string, whitened string, n string"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(i + first, v, *["clash"] * 4) for i, v in enumerate(vectors)], SCHEMA)


def check(rows, x, components=8):
    """Rows of whiten() against the eigenvectors of the covariance, for vectors with ids 0, 1, ..."""
    n, width = x.shape
    sums = x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = np.full((n, components), np.nan)
    shares = {}
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        shares[r.component] = r.explained
        assert r.n == n and r.identity_error <= 1e-9
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
    k = len(shares)
    assert not np.isnan(got[:, :k]).any() and sorted(shares) == list(range(1, k + 1))
    assert [shares[i + 1] for i in range(k)] == pytest.approx((values[:k] / values.sum()).tolist(), rel=1e-9)
    for j in range(k):
        want = centred @ vectors[:, j] / math.sqrt(values[j])
        assert min(np.abs(got[:, j] - want).max(), np.abs(got[:, j] + want).max()) < 1e-8
    return k


def integers(vectors):
    return np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000


def test_query_equals_eigenvectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    x = integers([r.embedding for r in rows.orderBy("vec_id").collect()])
    assert check(whitening.whiten(rows).collect(), x) == 8


def test_triangles_of_many_tasks_meet_in_a_tree(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(70)
    x = integers([r.embedding for r in rows.orderBy("vec_id").collect()])
    assert check(whitening.whiten(rows, components=3).collect(), x, 3) == 3


def test_unfit_rows_take_no_part(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(40, 5)).astype(np.float32).tolist()
    good[7] = good[8]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] + [0.0] * 4, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    rows = table(spark, good).unionByName(table(spark, bad, 100))
    assert check(whitening.whiten(rows).collect(), integers(good)) == 5
    nameless = whitening.whiten(table(spark, good).selectExpr("cast(null as long) as vec_id", "embedding"))
    assert nameless.count() == 200 and nameless.filter("vec_id is not null").isEmpty()


def test_without_variance_nothing_is_returned(spark):
    assert whitening.whiten(table(spark, [])).isEmpty()
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 9)).isEmpty()
    assert whitening.whiten(table(spark, [[1.0, 2.0]])).isEmpty()
    flat = [[float(i), 2.0 * i, 0.0] for i in range(20)]
    assert {r.component for r in whitening.whiten(table(spark, flat)).collect()} == {1}


def test_large_entries_are_exact_or_null(spark):
    rows = [[2.0**12 * i, float(i * i)] for i in range(30)]  # beyond what 64-bit products of differences bear
    assert check(whitening.whiten(table(spark, rows)).collect(), integers(rows)) == 2
    got = whitening.whiten(table(spark, [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0]])).collect()
    assert {r.vec_id: r.deviation for r in got} == {0: None, 1: None, 2: 3072**2} and all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("shape", [(300, 64), (40, 64), (5, 12), (200, 1), (30, 130)])
def test_solver_on_random_matrices(shape):
    rng = np.random.default_rng(shape[0])
    rows = rng.normal(size=shape) * np.logspace(0, -3, shape[1])
    values, found = whitening.directions(whitening.triangle(rows), shape[1])
    want = np.linalg.svd(rows, compute_uv=False)[: len(values)]
    assert np.sqrt(values) == pytest.approx(want, rel=1e-9)
    assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-10
    assert np.abs(np.linalg.norm(rows @ found, axis=0) - np.sqrt(values)).max() < 1e-9 * np.sqrt(values[0])


def test_solver_on_equal_singular_values():
    for rows in (np.vstack([np.eye(16), -np.eye(16)]), np.repeat(np.eye(6), 3, axis=0) - 1 / 6, np.diag([3.0, 3, 3, 1e-7, 1e-7])):
        values, found = whitening.directions(whitening.triangle(rows), rows.shape[1])
        want = np.linalg.svd(rows, compute_uv=False)[: len(values)]
        assert np.sqrt(values) == pytest.approx(want, rel=1e-8)
        assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-10


def test_small_singular_values_keep_their_digits():
    rng = np.random.default_rng(1)
    a, b = np.logspace(0, -9, 20), np.logspace(-1, -9, 19) * rng.uniform(0.5, 1, 19)
    found = whitening.squares((a * a).tolist(), (b * b).tolist())
    full = np.diag(a) + np.diag(b, 1)
    assert math.prod(found) == pytest.approx(math.prod((a * a).tolist()), rel=1e-11)  # the determinant
    assert sum(found) == pytest.approx(float((full * full).sum()), rel=1e-13)
