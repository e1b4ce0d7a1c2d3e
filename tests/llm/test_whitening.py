"""Whitening against numpy's eigenvectors of the covariance and exact integers."""

import math
import random

import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, id string, v int, whitened double"


def usable(vectors):
    return [v for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]


def brute(vectors, k):
    """Whole numbers, sums, leading eigenvalues and vectors, trace."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    y = x - np.array([s / len(x) for s in sums])
    values, turn = np.linalg.eigh(y.T @ y / len(x))
    return x, sums, y, values[::-1][:k], turn[:, ::-1][:, :k], values.sum()


def check(got, ids, vectors, k):
    x, sums, y, values, turn, trace = brute(vectors, k)
    n = len(x)
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    want = y @ turn / np.sqrt(values)
    assert len(got) == n * len(values)
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation) for r in got) == sorted(
        (str(i), c + 1, n, d) for i, d in zip(ids, deviation) for c in range(len(values))
    )
    for c in range(len(values)):
        rows = [r for r in got if r.component == c + 1]
        # By id where ids are unique; either sign.
        a = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id)])
        b = want[np.argsort(ids, kind="stable"), c]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert abs(rows[0].explained - values[c] / trace) <= 1e-12
    assert len({(r.identity_error) for r in got}) == 1 and got[0].identity_error < 1e-9


def table(spark, vectors, ids=None):
    rows = [(i, v, "id", 1, 0.5) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("dim, n, flat", [(70, 400, True), (70, 300, False), (5, 60, False), (1, 9, False)])
def test_against_numpy(spark, dim, n, flat):
    """A flat spectrum needs many filters; with few dimensions the block is the whole space."""
    rng = np.random.default_rng(dim + n)
    spread = np.ones(dim) if flat else 1.5 ** -np.arange(dim)
    vectors = [[float(np.float32(c)) for c in row] for row in rng.standard_normal((n, dim)) * spread + 0.3]
    got = W.digest(table(spark, vectors), 8).collect()
    check(got, list(range(n)), vectors, min(8, dim))


def test_dropped_rows(spark):
    rng = random.Random(5)
    good = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(80)]
    good = [[float(np.float32(c)) for c in v] for v in good]
    bad = [None, [], [None] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] * 6, [math.inf] + [0.0] * 5, [0.0] * 5, [3e38] * 6]
    got = W.digest(table(spark, good + bad), 8).collect()
    check(got, list(range(80)), good, 6)


def test_null_and_repeated_ids_and_blocks(spark):
    rng = random.Random(6)
    vectors = [[float(np.float32(rng.gauss(0, 1))) for _ in range(4)] for _ in range(50)]
    df = table(spark, vectors + vectors[:1], [None, 7, 7, *range(10, 57), None])
    found = W.Vectors(df, "embedding", "vec_id", 1024, 100000, block_bytes=100)
    assert found.blocks.count() > 10 and found.n == 51
    fitted = W.fit(found, 3)
    rows = W.transform(found, fitted).collect()
    assert sorted(str(r.id) for r in rows) == sorted(str(i) for i in [None, 7, 7, *range(10, 57), None])
    assert fitted.residuals.max() <= 1e-12 * fitted.eigenvalues[0]
    assert np.allclose(fitted.components.T @ fitted.components, np.eye(3), atol=1e-13)


def test_no_variance(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 9):
        assert W.digest(table(spark, vectors), 8).collect() == []
    # Two dimensions that always agree have one component.
    got = W.digest(table(spark, [[float(i), float(i)] for i in range(10)]), 8).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_exact_beyond_64_bits():
    x = np.array([[1 << 40, -5], [3, 1 << 41]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert W.deviations(x, 2, sums) == [sum((2 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]


def test_filter_damps_what_is_not_wanted():
    """Directions below the bound shrink against those above it."""
    values = np.array([4.0, 3.9, 2.0, 1.0, 0.5, 0.1])
    turned = W.filtered(lambda q: values[:, None] * q, np.ones((6, 1)), values[:, None], np.array([4.0, 2.0]))
    assert np.abs(turned[3:]).max() < 1e-3 * np.abs(turned[:2]).min()


def test_a_flat_spectrum_widens_the_block(spark, monkeypatch):
    """With one round before each widening the block becomes the whole space, and the result is the same."""
    monkeypatch.setattr(W, "ROUNDS", 1)
    rng = np.random.default_rng(2)
    vectors = [[float(np.float32(c)) for c in row] for row in rng.standard_normal((500, 90))]
    check(W.digest(table(spark, vectors), 8).collect(), list(range(500)), vectors, 8)


def test_query_over_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.table(spark, sf_dir, "embeddings").collect()
    kept = [r for r in rows if r.embedding and usable([r.embedding])]
    got = queries.op13_embedding_whitening(spark, sf_dir).collect()
    check(got, [r.vec_id for r in kept], [r.embedding for r in kept], 8)
