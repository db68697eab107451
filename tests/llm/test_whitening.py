import numpy as np
import pytest

from funnelwright.llm import whitening

KIND = "vec_id long, embedding array<float>, label int, component string, n string, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "n", "x") for i, v in rows], KIND)


def whole(vectors):
    return [[int(np.floor(float(np.float32(c)) * 1024)) + 100_000 for c in v] for v in vectors]


def check(found, ids, vectors):
    """Against the dense covariance; the sign of a component is free."""
    x = whole(vectors)
    n, k = len(x), min(8, len(x[0]))
    assert len(found) == n * k
    sums = [sum(column) for column in zip(*x, strict=True)]
    deviation = sorted((i, sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for i, row in zip(ids, x, strict=True))
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == deviation
    c = np.array(x, float) - np.array(sums) / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    expected = c @ basis / np.sqrt(values)
    place = {i: p for p, i in enumerate(ids)}
    actual = np.zeros((n, k))
    for r in found:
        actual[place[r.vec_id], r.component - 1] = r.whitened
    actual *= np.sign((actual * expected).sum(axis=0))
    assert np.abs(actual - expected).max() < 1e-9
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-10
    share = {r.component: r.explained for r in found}
    assert np.allclose([share[i + 1] for i in range(k)], values / np.square(c).sum() * n, rtol=1e-10)


def test_against_the_dense_covariance(spark, rng):
    vectors = [[rng.gauss(0.3, 0.1 + 0.05 * d) for d in range(24)] for _ in range(300)]
    vectors += vectors[:20]  # repeated rows
    ids = list(range(len(vectors)))
    bad = [(900, None), (901, [None] * 24), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (904, []), (905, [1.0, 2.0]), (906, [1e20] * 24)]
    found = whitening.whiten(table(spark, [*zip(ids, vectors, strict=True), *bad])).collect()
    check(found, ids, vectors)


def test_fewer_dimensions_than_components(spark, rng):
    vectors = [[rng.gauss(0, 1), rng.gauss(5, 2), rng.gauss(0, 3)] for _ in range(50)]
    check(whitening.whiten(table(spark, list(enumerate(vectors)))).collect(), list(range(50)), vectors)


def test_nothing_varies_and_empty(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    found = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation) for r in found) == [(i, c, 2, 0) for i in (0, 1) for c in (1, 2)]
    assert {(r.whitened, r.explained, r.identity_error) for r in found} == {(None, None, None)}
    # one direction varies
    line = whitening.whiten(table(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert {r.component: r.explained for r in line} == pytest.approx({1: 1.0, 2: 0.0})


def test_deviations_beyond_a_long_stay_exact(spark):
    vectors = [[float(2**28 * (i % 3)), 1.0] for i in range(30)]
    found = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    x = whole(vectors)
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in found:
        exact = sum((30 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert int(r.deviation_exact) == exact and r.deviation == (exact if exact < 1 << 63 else None)
    assert any(r.deviation is None for r in found)


@pytest.mark.parametrize("size, count", [(5, 5), (40, 8), (150, 8), (150, 1)])
def test_eigenpairs(size, count):
    a = np.random.default_rng(size).standard_normal((400, size)) * np.linspace(1, 2, size)
    v = a.T @ a / 400
    values, vectors = whitening.leading_eigenpairs(lambda p: v @ p, size, count)
    exact = np.linalg.eigvalsh(v)[::-1][:count]
    assert np.allclose(values, exact, rtol=1e-13)
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-13 * exact[0]
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-13


def test_equal_eigenvalues():
    v = np.diag([3.0, 3, 3, 2, 1, 0, 0, 0, 0, 0, 0, 0])
    values, vectors = whitening.leading_eigenpairs(lambda p: v @ p, 12, 8)
    assert np.allclose(values, [3, 3, 3, 2, 1, 0, 0, 0], atol=1e-14) and np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13


def test_minres_solves():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    b = np.column_stack([rng.standard_normal((12, 2)), np.zeros(12)])
    x = whitening.minres(lambda t: a @ t, b, 12)
    assert np.allclose(a @ x, b, atol=1e-8)
