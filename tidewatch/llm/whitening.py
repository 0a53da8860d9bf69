"""Whitening of embeddings by pivoted Cholesky of their scatter and one-sided Jacobi on the triangular factor.

Sums of the integer coordinates are exact.  The scatter is summed from centred rows, one small matrix from each task.  Its
factor L (pivoted, so that L L' is the scatter with rows and columns exchanged) is rotated from the right until all
columns are orthogonal: their squared norms are the eigenvalues, the normalised columns the components.  The
scatter is never multiplied again, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Entries of this size and more have no exact coordinate; such vectors count as not finite.
LARGEST = float(1 << 53) / SCALE
MOST_SWEEPS = 60


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(l, order): ``l`` lower triangular with a[order][:, order] = l l'; columns beyond the rank are left out."""
    a, d = a.astype(float), len(a)
    order, l = np.arange(d), np.zeros((d, d))
    rest = np.diag(a).copy()
    least = np.finfo(float).eps * d * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(rest[k:]))
        if rest[p] <= least:
            return l[:, :k], order
        for values in (order, rest):
            values[[k, p]] = values[[p, k]]
        l[[k, p], :k] = l[[p, k], :k]
        l[k, k] = np.sqrt(rest[k])
        l[k + 1 :, k] = (a[order[k + 1 :], order[k]] - l[k + 1 :, :k] @ l[k, :k]) / l[k, k]
        rest[k + 1 :] -= l[k + 1 :, k] ** 2
    return l, order


def _rounds(n: int):
    """Disjoint pairs of n columns (n even), all pairs over n - 1 rounds."""
    ring = list(range(n))
    for _ in range(n - 1):
        yield np.array(ring[: n // 2]), np.array(ring[: n // 2 - 1 : -1])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def orthogonal_columns(l: np.ndarray) -> np.ndarray:
    """``l`` rotated from the right until its columns are orthogonal; a round turns disjoint pairs at once."""
    n = l.shape[1]
    u = np.concatenate([l, np.zeros((len(l), n % 2))], axis=1)
    tolerance = np.finfo(float).eps * max(len(l), 1)
    for _ in range(MOST_SWEEPS):
        turned = False
        for i, j in _rounds(u.shape[1]) if u.shape[1] > 1 else ():
            a, b = u[:, i], u[:, j]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            open_pairs = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            if not open_pairs.any():
                continue
            turned = True
            i, j, a, b = i[open_pairs], j[open_pairs], a[:, open_pairs], b[:, open_pairs]
            zeta = (beta - alpha)[open_pairs] / (2 * gamma[open_pairs])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            u[:, i], u[:, j] = c * a - s * b, s * a + c * b
        if not turned:
            return u[:, :n]
    raise RuntimeError(f"columns were not orthogonal after {MOST_SWEEPS} sweeps")


def principal_components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) of ``scatter``, falling; the largest entry of a component is positive."""
    l, order = pivoted_cholesky(scatter)
    u = orthogonal_columns(l)
    norms = np.sqrt((u * u).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    components = np.empty((len(by_size), len(scatter)))
    components[:, order] = (u[:, by_size] / norms[by_size]).T
    most = np.abs(components).argmax(axis=1)
    components *= np.sign(components[np.arange(len(most)), most])[:, None]
    return norms[by_size] ** 2, components


def _coordinates(column: pa.ListArray, d: int) -> np.ndarray:
    return column.values[column.offsets[0].as_py() : column.offsets[-1].as_py()].to_numpy(zero_copy_only=False).reshape(-1, d)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the coordinates of vectors that are there and finite."""
    v = F.col("embedding").cast("array<double>")
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    return vectors.where(fits & (F.size(v) > 0)).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))


def _sums(d: int):
    """Per task the sums of all coordinates, of their upper and of their lower 32 bits, and the number of rows."""

    def run(batches):
        n, upper, lower = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _coordinates(batch.column(0), d)
            n, upper, lower = n + len(x), upper + (x >> 32).sum(axis=0), lower + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([[*upper.tolist(), *lower.tolist(), n]], pa.list_(pa.int64()))], ["s"])

    return run


def _products(d: int, project):
    """Per task, row by row, the matrix that its centred rows add up to, and their sum as the last row."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = project(_coordinates(batch.column(0), d))
                part = np.concatenate([y.T @ y, y.sum(axis=0)[None]])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    return run


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The matrix that all tasks' rows (i, v) add up to; its size is that of a vector, whatever the number of rows."""
    cells = rows.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((size + 1, size))
    for i, j, v in cells:
        out[i, j] = v
    return out


def _covariance(added: np.ndarray, n: int) -> np.ndarray:
    """Of nearly centred rows: what their mean still is is taken out."""
    mean = added[-1] / n
    found = added[:-1] / n - np.outer(mean, mean)
    return (found + found.T) / 2


def _whitened(d: int, n: int, sums: list[int], mean: np.ndarray, axes: np.ndarray, shares: list[float], error: float):
    k, far_sum = len(axes), max(abs(v) for v in sums)

    def deviation(x: np.ndarray) -> list[int]:
        # In 64 bits where nothing can overflow, else in Python's integers.
        if int(np.abs(x).max()) * n + far_sum < 1 << 62:
            y = n * x - np.array(sums)
            if d * float(np.abs(y).max()) ** 2 < 2.0**62:
                return (y * y).sum(axis=1).tolist()
        return [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]

    def run(batches):
        for batch in batches:
            x = _coordinates(batch.column(1), d)
            if not len(x):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            far = pa.array([v for v in deviation(x) for _ in range(k)], pa.int64())  # beyond 64 bits this raises
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(ids), n)),
                    far,
                    pa.array(((x - mean) @ axes.T).ravel()),
                    pa.array(np.tile(np.array(shares), len(x))),
                    pa.array(np.full(len(ids), error)),
                ],
                _NAMES,
            )

    return run


_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold a null or an entry that is not finite (or beyond 2^53 / SCALE) are dropped, and so
    are those of another length than most (of equally frequent lengths, the longest).  Components without variance
    are left out, so there may be fewer than asked for, and none where all vectors are equal or the table is empty: no
    rows then.  Repeated rows count and come back as often, also with a null id; other columns are ignored.  A deviation
    that 64 bits can't hold (from some millions of vectors on) is an error.

    Three passes read the table; from each task come one or two matrices the size of a vector squared.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], _RESULT)
    d = lengths.d
    rows = rows.where(F.size("x") == d)
    summed = rows.select("x").mapInArrow(_sums(d), "s array<bigint>").select(F.posexplode("s").alias("i", "s"))
    exact = {i: int(s) for i, s in summed.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect()}
    n, sums = exact[2 * d], [(exact[i] << 32) + exact[d + i] for i in range(d)]
    mean = np.array([float(Fraction(s, n)) for s in sums])

    centred = rows.select("x").mapInArrow(_products(d, lambda x: x - mean), "i int, v array<double>")
    scatter = _covariance(_added(centred, d), n) * n
    sizes, axes = principal_components(scatter)
    shares = (sizes / np.trace(scatter))[:components].tolist() if len(sizes) else []
    if not shares:
        return spark.createDataFrame([], _RESULT)
    axes = axes[:components] / np.sqrt(sizes[:components] / n)[:, None]
    white = rows.select("x").mapInArrow(_products(d, lambda x: (x - mean) @ axes.T), "i int, v array<double>")
    error = float(np.abs(_covariance(_added(white, len(axes)), n) - np.eye(len(axes))).max())
    return rows.mapInArrow(_whitened(d, n, sums, mean, axes, shares, error), _RESULT)
