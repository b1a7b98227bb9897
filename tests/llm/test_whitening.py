"""Whitening next to the eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from weftline.llm.whitening import _deviations, whitened_components

SCHEMA = "vec_id bigint, embedding array<float>, x int, `row` string, n int, component string"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 1, "r", 2, "c") for i, v in rows], SCHEMA)


def plain(matrix, top=8):
    x = np.floor(1024.0 * np.array(matrix, np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1], turned[:, ::-1]
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return centred @ turned[:, :top] / np.sqrt(values[:top]), values[:top] / values.sum(), deviation, n


def compare(rows, matrix, top=8):
    whitened, explained, deviation, n = plain(matrix, top)
    rows = sorted((r["row"]["vec_id"], r.component, r) for r in rows)
    got = np.array([r.whitened for _, _, r in rows]).reshape(len(matrix), top)
    for c in range(top):
        sign = np.sign(got[:, c] @ whitened[:, c])
        assert np.abs(got[:, c] - sign * whitened[:, c]).max() < 1e-9
    assert np.allclose([r.explained for _, _, r in rows[:top]], explained, rtol=1e-10)
    assert [r.deviation for _, c, r in rows if c == 1] == deviation.tolist()
    assert {r.n for _, _, r in rows} == {n} and max(r.identity_error for _, _, r in rows) < 1e-9


def test_equals_eigenvectors(vectors):
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((300, 12)) @ np.diag(np.linspace(3, 0.1, 12)) + 5.0
    rows = list(enumerate(matrix.tolist()))
    compare(whitened_components(vectors(rows), "embedding", ["vec_id"]).collect(), matrix)


def test_awkward_vectors(vectors):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 2.0], [math.inf, 0.0, 0.0], [1.0, 2.0]]
    rows = [*enumerate(good), *((100 + i, v) for i, v in enumerate(bad))]
    found = whitened_components(vectors(rows), "embedding", ["vec_id"]).collect()
    compare(found, good, top=3)  # three dimensions have three components
    twice = [*enumerate(good), (None, good[0]), (None, good[0])]
    assert len(whitened_components(vectors(twice), "embedding", ["vec_id"]).collect()) == 42 * 3


def test_equal_deviations_and_rank(vectors):
    corners = [[float(a), float(b), float(c), 1.0] for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    found = whitened_components(vectors(list(enumerate(corners))), "embedding", ["vec_id"]).collect()
    assert {r.component for r in found} == {1, 2, 3}  # the fourth dimension does not vary
    assert max(r.identity_error for r in found) < 1e-9
    assert all(abs(r.explained - 1 / 3) < 1e-12 for r in found)


def test_no_variance_and_no_rows(vectors):
    assert whitened_components(vectors([]), "embedding", ["vec_id"]).collect() == []
    assert whitened_components(vectors([(1, [1.0, 2.0])] * 3), "embedding", ["vec_id"]).collect() == []
    assert whitened_components(vectors([(1, None)]), "embedding", ["vec_id"]).collect() == []


def test_deviation_is_exact_or_null():
    x = np.array([[1 << 50, 0], [0, 1]], np.int64)
    assert _deviations(x, x.sum(axis=0), 2).to_pylist() == [None, None]
    small = np.array([[100_000, 99_990], [100_007, 100_001]], np.int64)
    assert _deviations(small, small.sum(axis=0), 2).to_pylist() == [170, 170]
