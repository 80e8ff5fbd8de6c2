"""Whitening against numpy's eigenvectors, with odd vectors that are to be left out."""

import math

import numpy as np
import pytest

from gridloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string, whitened string"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in vectors], SCHEMA).repartition(3)


def by_the_book(vectors, k=8):
    x = np.array([[math.floor(1024 * np.float64(np.float32(c))) + 100_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array((n * x - sums), float) / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), centred @ directions / np.sqrt(values), values / np.trace(covariance)


def test_against_numpy(spark):
    r = np.random.default_rng(5)
    good = (r.standard_normal((300, 12)) @ r.standard_normal((12, 12))).astype(np.float32).tolist()
    vectors = list(enumerate(good)) + [(7, good[0]), (None, good[1])]
    odd = [(900, None), (901, [None] * 12), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11), (904, []), (905, [1.0]), (906, [3e38] * 12)]
    found = whitening.whiten(make(spark, vectors + odd)).collect()
    n, deviations, whitened, explained = by_the_book(vectors)
    assert len(found) == 8 * n and {r["n"] for r in found} == {n}
    keys = [(-1 if i is None else i) for i, _ in vectors]
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == sorted(zip(keys, deviations, strict=True))
    for c in range(8):
        own = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["whitened"]) for r in found if r["component"] == c + 1)
        theirs = np.array([w for _, w in sorted(zip(keys, whitened[:, c], strict=True), key=lambda p: p[0])])
        own = np.array([w for _, w in own])
        single = [keys.count(k) == 1 for k in sorted(keys)]
        sign = np.sign(own[0] * theirs[0])
        assert np.allclose(own[single], sign * theirs[single], atol=1e-9)
    assert {round(r["explained"], 12) for r in found} == {round(e, 12) for e in explained}
    (error,) = {r["identity_error"] for r in found}
    assert error < 1e-10


def test_no_variance_and_few_entries(spark):
    assert whitening.whiten(make(spark, [])).collect() == []
    assert whitening.whiten(make(spark, [(1, None), (2, [])])).collect() == []
    same = whitening.whiten(make(spark, [(i, [1.0, 2.0]) for i in range(3)])).collect()
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in same] == [(None, 0.0, 0)] * 6
    line = whitening.whiten(make(spark, [(i, [float(i), float(i)]) for i in range(4)])).collect()
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True}
    assert max(r["explained"] for r in line) == pytest.approx(1.0)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_eigenvectors(n):
    r = np.random.default_rng(n)
    turned = np.linalg.qr(r.standard_normal((n, n)))[0]
    for values in (r.random(n), np.ones(n), np.repeat([5.0, 5.0, 2.0], n)[:n], np.arange(n) ** 9.0 * 1e-12):
        matrix = (turned * values) @ turned.T
        matrix = (matrix + matrix.T) / 2
        k = min(8, n)
        found, vectors = whitening.eigenvectors(matrix, k)
        scale = max(np.abs(values).max(), 1e-300)
        assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * scale)
        assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-12)
        assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=1e-12 * scale)


def test_deviations_beyond_longs():
    x = np.array([[2**31, 5], [7, 5]])
    sums = np.array([2**31 * 2**30, 5 * 2**30], object)
    exact = [((2**30 * int(a) - sums[0]) ** 2) for a in x[:, 0]]
    assert whitening._deviations(x, 2**30, sums) == [v if v < 2**63 else None for v in exact]
