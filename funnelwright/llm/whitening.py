"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance V is never formed. A product V P of a few columns P is one pass over the stored rows: each
task adds up c (c^T P) over its centred rows c and sends one small matrix, and Spark sums those. The driver
holds the search space only (dimension times a few dozen numbers, whatever the number of rows):

* Rayleigh-Ritz on the space gives approximate eigenpairs and their residuals;
* pairs whose residual is that of double precision are locked, in falling order, and the space is kept orthogonal to them;
* for the others the correction equation (I - ZZ^T)(V - theta I)(I - ZZ^T) t = -r, Z the locked and the
  current vectors, is solved by a few steps of MINRES, for all of them in the same passes;
* the corrections extend the space, which restarts from its best vectors when it is full.

At the end all residuals are computed anew. Rows are whole numbers x = floor(scale * c) + offset. The mean is
exact: x - S/n is (x - q) - r/n with S = q n + r, so centring loses no digits.

Results in special cases: rows whose vector is NULL, empty, or holds a NULL or non-finite entry (or one of 2**30 or more, where
sums could leave a long) take no part; of vectors of several lengths those of the most frequent one (then the longest) do; rows with a NULL id, and
repeated rows, count like all others. There are as many components as dimensions if those are fewer than asked. A component
without variance has no whitened values (NULL) and no part in ``identity_error``; ``explained`` is NULL if nothing varies. Of equal
eigenvalues any basis may be returned. ``deviation`` is NULL where it does not fit in a long; ``deviation_exact`` holds it always.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .batches import pick

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries at least this large take no part.
LARGEST = float(1 << 30)
# Steps of the inner solver, rounds of the outer one, and columns of the space in units of the components asked for.
INNER_STEPS, ROUNDS, SPACE = 2, 200, 8
SEED = 11
# A residual is that of double precision below so many units in the last place of the largest eigenvalue.
UNITS = 64
# Rows of an Arrow batch handled at once.
ROWS = 1 << 14

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_exact decimal(38,0)"
)


def fit_rows(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x (whole numbers) of the rows that take part, stored."""
    plain = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c")
    )
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    fit = plain.where(F.coalesce(F.forall("c", finite) & (F.size("c") > 0), F.lit(False)))
    rows = staged(fit.select("vec_id", F.transform("c", lambda c: F.floor(c * scale) + offset).alias("x")), "whitening")
    size = F.size("x").alias("size")
    most = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("x") == most[0]["size"]) if most else rows


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def totals(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """The sum over all rows of what ``part`` makes of some of them, an array of fixed size, flattened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _pieces(batches):
            found = part(_matrix(batch)).ravel()
            total = found if total is None else total + found
        if total is not None:
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], names=["place", "value"])

    value = F.col("value") if kind == "double" else F.col("value").cast("decimal(38,0)")
    summed = rows.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum(value).alias("value"))
    return [row["value"] for row in sorted(summed.collect())]


class Fit:
    """Centred rows of a stored table, and products with their covariance."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.n = rows.count()
        sums = [int(s) for s in totals(rows, lambda x: x.sum(axis=0), "long")]
        self.size = len(sums)
        self.whole = np.array([s // self.n for s in sums], dtype=np.int64)
        self.rest = np.array([s % self.n for s in sums], dtype=np.int64)
        self.products = 0

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        whole, fraction = self.whole, self.rest / self.n
        return lambda x: (x - whole) - fraction

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times some columns, in one pass over the rows."""
        centred = self.centring()

        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ columns)

        self.products += 1
        return np.array(totals(self.rows, part)).reshape(columns.shape) / self.n

    def trace(self) -> float:
        centred = self.centring()
        return totals(self.rows, lambda x: np.array([np.square(centred(x)).sum()]))[0] / self.n


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the orthonormal ``against``."""
    out = against
    for column in columns.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = column - out @ (out.T @ column)
        left = np.linalg.norm(column)
        if size and left > 1e-10 * size:
            column = column / left
            column = column - out @ (out.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out[:, against.shape[1] :]


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, after some steps of MINRES from zero."""
    ratio = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b != 0)
    beta = np.linalg.norm(right, axis=0)
    v, v_old = right * ratio(np.ones_like(beta), beta), np.zeros_like(right)
    w, w_old, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cos, cos_old = np.ones_like(beta), np.ones_like(beta)
    sin, sin_old = np.zeros_like(beta), np.zeros_like(beta)
    eta = beta.copy()
    for _ in range(steps):
        image = apply(v) - beta * v_old
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v
        beta_new = np.linalg.norm(image, axis=0)
        first = cos * alpha - cos_old * sin * beta
        length = np.hypot(first, beta_new)
        second, third = sin * alpha + cos_old * cos * beta, sin_old * beta
        cos_old, cos, sin_old, sin = cos, ratio(first, length), sin, ratio(beta_new, length)
        w_old, w = w, (v - third * w_old - second * w) * ratio(np.ones_like(length), length)
        x = x + cos * eta * w
        eta = -sin * eta
        v_old, v, beta = v, image * ratio(np.ones_like(beta_new), beta_new), beta_new
    return x


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], size: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix known by its products."""
    empty = np.zeros((size, 0))
    locked, space = empty, orthonormal(np.random.default_rng(SEED).standard_normal((size, min(size, count + 4))), empty)
    images = product(space)
    norm = 0.0
    for _ in range(ROUNDS):
        # Rayleigh-Ritz: the space becomes its Ritz vectors, best first
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        residual = images - space * values
        norm = max(norm, np.abs(values).max(initial=0.0))
        exact = np.linalg.norm(residual, axis=0) <= UNITS * np.finfo(float).eps * norm
        spanned = locked.shape[1] + space.shape[1] == size
        done = 0
        while done < len(values) and locked.shape[1] + done < count and exact[done]:
            done += 1
        locked = np.column_stack([locked, space[:, :done]])
        space, images, residual, values = space[:, done:], images[:, done:], residual[:, done:], values[done:]
        if locked.shape[1] == count:
            # every pair once more, from fresh products
            fresh = product(locked)
            values = (locked * fresh).sum(axis=0)
            worst = np.linalg.norm(fresh - locked * values, axis=0).max()
            if worst <= UNITS * np.finfo(float).eps * norm:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            space, locked = orthonormal(np.column_stack([locked, space]), empty), empty
            images = product(space)
            continue
        if spanned:  # nothing to extend the space by: only its images are inexact
            space = orthonormal(space, locked)
            images = product(space)
            continue
        wanted = min(count, space.shape[1])  # also beyond those still missing: a pass costs the same
        if space.shape[1] + wanted > SPACE * count:
            # images anew as well, so that rounding does not build up over restarts
            space = orthonormal(space[:, : 2 * count], locked)
            images = product(space)
        current = space[:, :wanted]
        outside = np.column_stack([locked, current])
        project = lambda t, z=outside: t - z @ (z.T @ t)
        shift = values[:wanted]
        apply = lambda t, p=project, s=shift: p(product(p(t)) - s * p(t))
        corrections = minres(apply, project(-residual[:, :wanted]), INNER_STEPS)
        added = orthonormal(corrections, np.column_stack([locked, space]))
        if not added.shape[1]:
            # residuals too small to lead anywhere new: look in fresh directions
            fresh = np.random.default_rng(SEED + locked.shape[1]).standard_normal((size, wanted))
            added = orthonormal(fresh, np.column_stack([locked, space]))
        space, images = np.column_stack([space, added]), np.column_stack([images, product(added)])
    raise ArithmeticError(f"no {count} eigenpairs to double precision after {ROUNDS} rounds")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Every row's whitened components; columns as in ``RESULT``."""
    rows = fit_rows(vectors, scale, offset)
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], RESULT)
    fit = Fit(rows)
    count = min(components, fit.size)
    values, basis = leading_eigenpairs(fit.product, fit.size, count)
    trace = fit.trace()
    varies = values > fit.size * np.finfo(float).eps * trace
    centred, n = fit.centring(), fit.n
    turn = basis[:, varies] / np.sqrt(values[varies])
    means = np.array(totals(rows, lambda x: (centred(x) @ turn).sum(axis=0))) / n if varies.any() else np.zeros(0)

    def spread(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ turn - means
        return z.T @ z

    error = None
    if varies.any():
        covariance = np.array(totals(rows, spread)).reshape(len(means), -1) / n
        error = float(np.abs(covariance - np.eye(len(means))).max())
    explained = [float(max(v, 0.0) / trace) if trace > 0 else None for v in values]
    whole, rest, size = fit.whole, fit.rest, fit.size

    def deviations(x: np.ndarray) -> list[int] | np.ndarray:
        y = x - whole
        if size * (float(n) * (float(np.abs(y).max()) + 1)) ** 2 < 2.0**62:
            return np.square(n * y - rest).sum(axis=1)
        return [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True)) for row in y.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            m, x = batch.num_rows, _matrix(batch)
            whitened = np.full((m, count), np.nan)
            whitened[:, varies] = centred(x) @ turn
            row = pa.array(np.repeat(np.arange(m), count))
            exact = pa.array([int(d) for d in deviations(x)], pa.decimal128(38, 0))
            fits = pa.array([int(d) if d < 1 << 63 else None for d in exact.to_pylist()], pa.int64())
            columns = [
                batch.column("vec_id").take(row),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                pa.array(np.full(m * count, n)),
                fits.take(row),
                pa.array(whitened.ravel(), from_pandas=True),
                pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * count), pa.float64()),
                exact.take(row),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [part.split()[0] for part in RESULT.split(", ")]
    return rows.mapInArrow(run, RESULT)
