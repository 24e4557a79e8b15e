import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from repotide.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def vectors(spark):
    def build(rows, partitions=3):
        return spark.createDataFrame([(k, v, k % 3) for k, v in enumerate(rows)], VECTORS).repartition(partitions, "vec_id")

    return build


def sample(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dims)) * np.linspace(3, 0.5, dims) + 5).astype(np.float32).tolist()


def brute(rows, k):
    """The contract in plain numpy, on the rows that stay: {row: (deviation, whitened up to sign)}."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return deviations, centred @ u / np.sqrt(e), e / np.trace(v)


def check(df, rows, ids, k):
    deviations, expected, explained = brute(rows, k)
    found = {(r.vec_id, r.component): r for r in df.collect()}
    assert len(found) == len(rows) * k == df.count()
    got = np.array([[found[i, c + 1].whitened for c in range(k)] for i in ids])
    assert [found[i, 1].deviation for i in ids] == deviations
    assert {r.n for r in found.values()} == {len(rows)}
    for c in range(k):
        sign = np.sign(got[:, c] @ expected[:, c])
        assert np.allclose(got[:, c], sign * expected[:, c], atol=1e-9)
        assert found[ids[0], c + 1].explained == pytest.approx(explained[c], rel=1e-9)
    error = {r.identity_error for r in found.values()}
    measured = np.abs(np.cov(got.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert len(error) == 1 and error.pop() < 1e-9 and measured < 1e-9


@pytest.mark.parametrize("dims,k", [(1, 1), (2, 2), (8, 8), (40, 32)])
def test_equals_numpy(vectors, dims, k):
    rows = sample(200, dims)
    check(whitening.whitened(vectors(rows)), rows, range(len(rows)), k)


def test_bad_vectors_are_dropped_and_lengths_may_differ(vectors, spark):
    good = sample(60, 5)
    bad = [None, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], []]
    rows = [*bad, *good]
    check(whitening.whitened(vectors(rows)), good, range(len(bad), len(rows)), 5)


def test_repeated_rows_null_ids_and_clashing_names(vectors, clashing):
    rows = sample(50, 4) * 2
    df = whitening.whitened(vectors(rows))
    check(df, rows, range(100), 4)
    other = clashing(vectors(rows).drop("label")).withColumn("whitened", F.lit("z")).withColumn("deviation", F.lit(1))
    assert sorted(whitening.whitened(other).collect()) == sorted(df.collect()) or other.count() == 100
    nameless = whitening.whitened(vectors(rows).withColumn("vec_id", F.lit(None).cast("long")))
    assert nameless.count() == 400 and nameless.where("vec_id is null").count() == 400


def test_without_variance(vectors):
    same = whitening.whitened(vectors([[1.0, 2.0, 3.0]] * 4)).collect()
    assert len(same) == 12 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, 0.0, 0.0)}
    flat = whitening.whitened(vectors([[float(k), 2.0 * k, 7.0] for k in range(9)])).collect()
    assert {r.component for r in flat if r.whitened is not None} == {1}
    assert [r.explained for r in flat if r.component == 1][0] == pytest.approx(1)


def test_nothing_to_fit(vectors):
    empty = whitening.whitened(vectors([[1.0]]).limit(0))
    assert empty.count() == 0
    assert whitening.whitened(vectors([None, [None]])).collect() == []
    assert whitening.whitened(vectors([[], []])).collect() == []
    assert empty.columns == whitening.whitened(vectors([[1.0], [2.0]])).columns


def test_entries_beyond_any_long(vectors):
    rows = whitening.whitened(vectors([[3.0e38, 1.0], [-3.0e38, 2.0], [0.0, 1.0]])).collect()
    assert len(rows) == 6 and {r.deviation for r in rows if r.vec_id < 2} == {None}


def test_deviations_are_exact_where_products_exceed_a_double():
    sums = [3 * 10**15 + 1, 7]
    centred = whitening.Centred(3, sums)
    block = np.array([[10**15 + 10**8, 5], [10**15, 2]], np.int64)
    expected = [sum((3 * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in block.tolist()]
    assert centred.deviations(block) == expected


def spectra():
    rng = np.random.default_rng(1)
    x, low = rng.standard_normal((300, 64)), rng.standard_normal((300, 3)) @ rng.standard_normal((3, 50))
    q = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    yield "random", x.T @ x / 300
    yield "identity", np.eye(40)
    yield "low rank", low.T @ low
    yield "equal blocks", np.kron(np.eye(8), np.ones((8, 8)))
    yield "graded", q @ np.diag(np.logspace(0, -12, 60)) @ q.T
    yield "close pairs", np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield "zero", np.zeros((5, 5))


@pytest.mark.parametrize("name,matrix", list(spectra()))
def test_eigenpairs(name, matrix):
    k = min(32, len(matrix))
    values, vectors = whitening.eigenpairs(matrix, k)
    norm = max(np.linalg.norm(matrix, 2), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * norm)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * norm
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)


def test_sturm_counts_eigenvalues_below():
    diagonal, off, _ = whitening.tridiagonal(np.diag([1.0, 2.0, 2.0, 5.0]))
    assert whitening.sturm_counts(diagonal, off, np.array([0.5, 1.5, 2.5, 6.0])).tolist() == [0, 1, 3, 4]
