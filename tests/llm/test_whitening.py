"""Whitening against eigenvectors of the covariance in numpy and exact sums in Python."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from reelhouse.llm import whitening as w
from reelhouse.llm.queries import op13_whitening

COLUMNS = "vec_id long, embedding array<float>"


def whole(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def exact(vectors):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]


def check(rows, found, components=32, rank=None):
    """``found`` against the rows (id, vector), by numpy and plain integers; ids are unique."""
    rows = whole(rows)
    x = exact(v for _, v in rows)
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d if rank is None else rank)
    by = defaultdict(dict)
    for r in found:
        by[r.vec_id][r.component] = r
    assert set(by) == {i for i, _ in rows} and all(sorted(c) == list(range(1, k + 1)) for c in by.values())
    out = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    for (i, _), own in zip(rows, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(own, sums))
        assert all(r.n == n and r.deviation == deviation for r in by[i].values())
    expected = centred @ vectors[:, :k] / np.sqrt(values[:k])
    apart = np.ones(k, bool)
    if d > 1:
        gaps = np.abs(np.diff(values))[: k] / values[0]
        apart[: len(gaps)] &= gaps > 1e-6
        apart[1:] &= gaps[: k - 1] > 1e-6
    for c in np.flatnonzero(apart):
        sign = np.sign(out[:, c] @ expected[:, c])
        assert np.allclose(sign * out[:, c], expected[:, c], atol=1e-6)
    first = by[rows[0][0]]
    for c in range(k):
        assert first[c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-4)
    assert np.abs(out.T @ out / n - np.eye(k)).max() < 1e-6
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-4


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, op13_whitening(spark, folder).collect())


@pytest.mark.parametrize("spread", [1.0, 1e4])
def test_badly_scaled_and_correlated(spark, spread):
    """Scales over many powers of ten and nearly equal dimensions, where squares of the scales lose digits."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 8)) * np.geomspace(1, spread, 8)
    base[:, 3] = base[:, 4] + rng.normal(size=600) * 0.02
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(base)]
    check(rows, w.whitened(spark.createDataFrame(rows, COLUMNS).repartition(5)).collect())


def test_dependent_dimensions_have_no_component(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(-50, 50, size=(300, 3)).astype(float)
    rows = [(i, [*v, v[0], 7.0, v[1] + v[2]]) for i, v in enumerate(a.tolist())]
    check(rows, w.whitened(spark.createDataFrame(rows, COLUMNS)).collect(), rank=3)


def test_what_is_left_out(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(50)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("-inf"), 0.0, 0.0, 0.0])]
    other = [(104, []), (105, [1.0, 2.0]), (106, [1.0] * 9)]
    df = spark.createDataFrame([*rows, *bad, *other], COLUMNS).selectExpr("*", "'a' AS x", "1 AS n", "2 AS component", "3 AS d")
    check(rows, w.whitened(df, w.Whitening(components=3)).collect(), components=3)


def test_repeated_rows_null_ids_and_nothing(spark):
    rng = np.random.default_rng(8)
    rows = [(i % 5 if i % 7 else None, rng.normal(size=3).tolist()) for i in range(60)]
    out = w.whitened(spark.createDataFrame(rows, COLUMNS)).collect()
    assert len(out) == 180 and sum(r.vec_id is None for r in out) == 3 * sum(i is None for i, _ in rows)
    assert w.whitened(spark.createDataFrame([], COLUMNS)).count() == 0
    assert w.whitened(spark.createDataFrame([(1, [2.0, 3.0])], COLUMNS)).count() == 0
    assert w.whitened(spark.createDataFrame([(1, [2.0, 3.0])] * 9, COLUMNS)).count() == 0
    assert w.whitened(spark.createDataFrame([(1, None), (2, [])], COLUMNS)).count() == 0


def test_deviations_beyond_a_long():
    x = np.array([[10**6, 10**6 + 5], [10**6 + 40_000, 10**6]])
    n, sums = 10**6, np.array([10**12, 10**12])
    assert w.deviations(x, n, sums) == [25 * 10**12, None]
    assert w.deviations(x, 2, x.sum(axis=0)) == [40_000**2 + 25, 40_000**2 + 25]
