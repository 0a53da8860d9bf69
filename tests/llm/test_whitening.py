import numpy as np
import pytest

from tidewatch.llm.whitening import orthogonal_columns, pivoted_cholesky, principal_components, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int, x bigint, i int, v string, component int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(k, v, 0, 1, 2, "v", 3) for k, v in zip(ids, vectors, strict=True)], SCHEMA)


def brute(vectors, k=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)) + 1_000_000
    y = x - x.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / len(y))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    n = len(x)
    far = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0))) for row in x]
    return (y @ u) / np.sqrt(e), e / np.trace(y.T @ y / n), far


def matrix(rows, column, k):
    out = np.zeros((max(r.vec_id for r in rows) + 1, k))
    for r in rows:
        out[r.vec_id, r.component - 1] = r[column]
    return out


@pytest.mark.parametrize("d", [5, 8, 40])
def test_against_eigh(spark, d):
    r = np.random.default_rng(d)
    vectors = (r.normal(size=(300, d)) @ r.normal(size=(d, d))).tolist()
    rows = whiten(table(spark, vectors).repartition(4)).collect()
    k = min(d, 32)
    white, shares, far = brute(vectors, k)
    got = matrix(rows, "whitened", k)
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-8)
    assert np.allclose(matrix(rows, "explained", k)[0], shares, rtol=1e-9)
    assert matrix(rows, "deviation", k)[:, 0].tolist() == [float(f) for f in far]
    assert {r.deviation for r in rows} == set(far)
    error = {r.identity_error for r in rows}
    assert len(error) == 1 and error.pop() < 1e-9
    assert {r.n for r in rows} == {300}


def test_rows_that_go_and_rows_that_stay(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(1)
    good = r.normal(size=(30, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 2.0], [1.0, inf, 2.0], [1.0, -inf, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0]]
    rows = whiten(table(spark, [*good, *bad, good[0]], [*range(30), *range(100, 108), None])).collect()
    assert {r.vec_id for r in rows} == {*range(30), None}
    assert {r.n for r in rows} == {31}
    first = sorted(r.whitened for r in rows if r.vec_id == 0)
    assert first == pytest.approx(sorted(r.whitened for r in rows if r.vec_id is None))


def test_tables_without_variance(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [None, []])).count() == 0
    assert whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    flat = whiten(table(spark, [[float(k), 2.0, float(2 * k)] for k in range(9)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12


def test_deviations_beyond_float_precision_are_exact(spark):
    vectors = [[float(1 << 20), 3.0], [-float(1 << 20), 5.0], [1.0, 7.0]]
    x = [[int(64 * c) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    got = {r.vec_id: r.deviation for r in whiten(table(spark, vectors)).collect()}
    assert got == {k: sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for k, row in enumerate(x)}


def test_more_than_64_bits_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow|too large|int64|out of bounds"):
        whiten(table(spark, [[float(1 << 40)], [0.0]])).collect()


def test_cholesky_factor_and_small_eigenvalues():
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.normal(size=(12, 12)))[0]
    wanted = 10.0 ** -np.arange(12)
    a = (q * wanted) @ q.T
    a = (a + a.T) / 2
    l, order = pivoted_cholesky(a)
    assert np.allclose(l @ l.T, a[order][:, order], atol=1e-14)
    assert np.allclose(l, np.tril(l))
    u = orthogonal_columns(l)
    off = u.T @ u - np.diag((u * u).sum(axis=0))
    assert np.abs(off).max() < 1e-14
    sizes, axes = principal_components(a)
    assert np.allclose(sizes, wanted, rtol=1e-6, atol=1e-15)
    assert np.allclose(axes @ axes.T, np.eye(12), atol=1e-8)
    assert pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)
    low = r.normal(size=(6, 2))
    assert pivoted_cholesky(low @ low.T)[0].shape == (6, 2)
