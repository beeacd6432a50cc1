"""Whitening beside numpy's own eigenvectors, and on vectors that have none."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicflow.llm import whitening
from topicflow.llm.queries import queries

DATA = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long"


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 5) for i, v in enumerate(vectors)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 40])
def test_householder_keeps_the_matrix(n):
    a = np.random.default_rng(n).standard_normal((n, n))
    a = a + a.T
    d, off, q = whitening.tridiagonal(a)
    t = np.diag(d) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ t @ q.T, a, atol=1e-12) and np.allclose(q.T @ q, np.eye(n), atol=1e-13)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 14), st.integers(0, 10_000), st.sampled_from([1e-8, 1.0, 1e9]))
def test_eigenvalues_and_vectors_equal_numpys(n, seed, scale):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = np.sort(rng.choice([1.0, 1.0, 2.0, 2.0 + 1e-13, 5.0, rng.uniform(0.1, 9)], n))[::-1] * scale
    a = q * values @ q.T
    a = (a + a.T) / 2
    vectors, found = whitening.leading_components(a, n)
    assert np.allclose(found, values, rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-11  # clusters too
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * scale * n * 10


def test_sturm_counts():
    d, off = np.array([2.0, 2.0, 2.0]), np.array([0.0, 0.0])
    assert whitening.sturm_counts(d, off, np.array([1.0, 2.5])).tolist() == [0, 3]
    assert len(whitening.leading_components(np.zeros((3, 3)), 2)[1]) == 0


def exact(vectors):
    """The covariance and deviations in fractions."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    centred = [[r[i] - Fraction(sums[i], n) for i in range(d)] for r in x]
    v = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    return v, np.array([[float(c) for c in r] for r in centred]), [sum((n * r[i] - sums[i]) ** 2 for i in range(d)) for r in x]


def check(rows, ids, vectors, k):
    v, centred, far = exact(vectors)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    found = np.full((len(ids), k), np.nan)
    for r in rows:
        at = ids.index(r["vec_id"])
        found[at, r["component"] - 1] = r["whitened"]
        assert (r["n"], r["deviation"]) == (len(ids), far[at])
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(v), rel=1e-9)
        assert r["identity_error"] < 1e-8
    want = centred @ axes / np.sqrt(values)
    for j in range(k):
        assert min(np.abs(found[:, j] - want[:, j]).max(), np.abs(found[:, j] + want[:, j]).max()) < 1e-7


def test_whitened_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((60, 7)) @ rng.standard_normal((7, 7))
    bad = [None, [], [1.0] * 3, [None] * 7, [float("nan")] * 7, [1, 2, 3, 4, 5, 6, float("-inf")]]
    rows = whitening.whiten(frame(spark, [*vectors, *bad]), components=5).collect()
    check(rows, list(range(60)), vectors, 5)
    assert len(rows) == 300


def test_query_equals_brute_force(spark):
    rows = queries()["op13_whitening"](spark, DATA).collect()
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    check(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table], 32)
    assert len(rows) == 32 * len(table)


def test_partitions_do_not_change_it(spark):
    vectors = np.random.default_rng(2).standard_normal((50, 6))
    one, many = ({(r["vec_id"], r["component"]): r for r in whitening.whiten(frame(spark, vectors, p)).collect()} for p in (1, 7))
    assert all(one[k]["explained"] == r["explained"] and one[k]["whitened"] == pytest.approx(r["whitened"], abs=1e-12) for k, r in many.items()) and len(one) == len(many)


def test_vectors_without_components(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [None, []])).count() == 0
    assert whitening.whiten(frame(spark, [[0.3, 0.5]] * 9)).count() == 0
    some = whitening.whiten(frame(spark, [[1.0, 2.0, 5.0], [3.0, 6.0, 5.0], [3.0, 6.0, 5.0], [-1.0, 0.0, 5.0]]))
    assert sorted({r["component"] for r in some.collect()}) == [1, 2]  # the third entry never changes
    assert some.count() == 8


def test_very_large_entries_have_exact_or_no_deviation(spark):
    vectors = [[1e37, 0.0], [-1e37, 1.0], [0.5, 0.5]]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert {(r["vec_id"], r["deviation"]) for r in rows} == {(0, None), (1, None), (2, 64**2)} and all(math.isfinite(r["whitened"]) for r in rows)
    assert whitening.deviations(np.array([[1 << 40, 0]]), 3, (1, 2)) == [None]
    assert whitening.deviations(np.array([[3, 4]]), 2, (1, 1)) == [25 + 49]


def test_wide_vectors_are_refused(spark):
    wide = spark.range(3).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(1.0), whitening.MOST_DIMENSIONS + 1).alias("embedding"))
    with pytest.raises(ValueError, match="at most"):
        whitening.whiten(wide)
