"""Whitened embeddings, with the principal components found by FEAST.

Vectors become whole numbers; each distinct one counts once in the mean and the
covariance, which Spark adds up over all of them. What is left is a symmetric
matrix with a row per dimension. Its largest eigenvalues are fenced in by
inertia counts (signs of the pivots of shifted factorisations). For each
interval, systems with the covariance shifted to points of a circle around it
are solved and added up, a quadrature of the resolvent that projects onto the
interval's eigenvectors; Rayleigh-Ritz in that subspace gives the pairs, and
their number must be the one that the inertia counts tell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.plans.handoff import written

from .common import free_name

#: Steps of an entry's unit.
STEPS = 256
COMPONENTS = 4
#: Points of the quadrature on half a circle; the other half is conjugate.
POINTS = 8
#: Eigenvalues of an interval, and how much larger its upper end may be, before it is cut.
MOST, WIDEST = 16, 8.0
ROUNDS = 12
_EPS = float(np.finfo(float).eps)
_PIVOT = (1 + 17**0.5) / 8


# --- eigenpairs of a symmetric matrix --------------------------------------------------------


def count_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below ``shift``: by Sylvester's law of inertia as many as an LDLᵀ of the shifted matrix has negative pivots.

    Pivots are one or two rows (Bunch and Kaufman).
    """
    a = matrix - shift * np.eye(len(matrix))
    found, k, n = 0, 0, len(a)

    def swap(p: int, q: int) -> None:
        a[[p, q], k:] = a[[q, p], k:]
        a[k:, [p, q]] = a[k:, [q, p]]

    while k < n:
        here, column = abs(a[k, k]), np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        largest = float(column.max(initial=0.0))
        if max(here, largest) == 0:
            k += 1
            continue
        width = 1
        if here < _PIVOT * largest:
            row = np.abs(a[k:, r])
            row[r - k] = 0
            beside = row.max()
            if here * beside < _PIVOT * largest**2:
                if abs(a[r, r]) >= _PIVOT * beside:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    width = 2
        block = a[k : k + width, k : k + width]
        found += int((np.linalg.eigvalsh(block) < 0).sum())
        below = a[k + width :, k : k + width]
        a[k + width :, k + width :] -= below @ np.linalg.solve(block, below.T)
        k += width
    return found


@dataclass(frozen=True)
class Interval:
    low: float
    high: float
    count: int


def top_intervals(matrix: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals that together hold the ``wanted`` largest eigenvalues, ties with the last included; zeros are left out.

    The matrix is positive semidefinite up to rounding.
    """
    n = len(matrix)
    bound = float(np.abs(matrix).sum(1).max(initial=0.0)) * (1 + n * _EPS)
    zero = bound * n * _EPS * 4

    def above(shift: float) -> int:
        return n - count_below(matrix, shift)

    wanted = min(wanted, above(zero)) if bound else 0
    if not wanted:
        return []
    low, high, count = zero, bound, above(zero)
    while count > wanted and high - low > 1e-11 * high:
        middle = (low * high) ** 0.5 if high > WIDEST * low else (low + high) / 2
        if (there := above(middle)) >= wanted:
            low, count = middle, there
        else:
            high = middle
    found, open_ones = [], [(low, bound, count, 0)]
    while open_ones:
        low, high, of_low, of_high = open_ones.pop()
        inside = of_low - of_high
        if not inside:
            continue
        if (inside <= MOST and high <= WIDEST * low) or high - low <= 1e-11 * high:
            found.append(Interval(low, high, inside))
            continue
        middle = (low * high) ** 0.5 if high > WIDEST * low else (low + high) / 2
        there = above(middle)
        open_ones += [(low, middle, of_low, there), (middle, high, there, of_high)]
    return found


def feast(matrix: np.ndarray, interval: Interval) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues inside the interval, with unit eigenvectors as columns; fails if they are not as many as counted.

    Where further eigenvalues crowd around the ends of the interval, the circle
    hardly tells them apart; the subspace is then doubled, at most to all dimensions.
    """
    n = len(matrix)
    size = min(n, 2 * interval.count + 8)
    while True:
        values, vectors, residual = _projected_pairs(matrix, interval, size)
        if residual <= 100 * n * _EPS * np.abs(matrix).sum(1).max():
            return values, vectors
        if size == n:
            raise ArithmeticError(f"{interval.count} eigenvalues between {interval.low} and {interval.high}, not all found")
        size = min(n, 2 * size)


def _projected_pairs(matrix: np.ndarray, interval: Interval, size: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Pairs of the interval from a subspace of so many columns, and the largest residual; infinite if too few are there."""
    n = len(matrix)
    enough = 4 * _EPS * float(np.abs(matrix).sum(1).max())
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(1j * np.pi / 2 * (1 - points))
    basis = np.random.default_rng(5).standard_normal((n, size))
    best = np.zeros(0), np.zeros((n, 0)), np.inf
    for _ in range(ROUNDS):
        projected = np.zeros((n, size))
        for turn, weight in zip(turns, weights):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(n) - matrix, basis.astype(complex))
            projected += weight / 2 * (radius * turn * solved).real
        frame, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(frame.T @ matrix @ frame)
        basis = frame @ turned
        residuals = np.linalg.norm(matrix @ basis - basis * values, axis=0)
        slack = 1e-9 * radius  # an end of an interval that is as narrow as rounding
        inside = np.flatnonzero((values > interval.low - slack) & (values < interval.high + slack))
        inside = inside[np.argsort(residuals[inside])][: interval.count]
        worst = float(residuals[inside].max(initial=0.0)) if len(inside) == interval.count else np.inf
        stalled = worst > best[2] / 2
        if worst < best[2]:
            best = values[inside], basis[:, inside], worst
        if best[2] <= enough or (stalled and best[2] < np.inf):
            break
    return best


def top_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns; fewer if the rest are zero."""
    pairs = [feast(matrix, interval) for interval in top_intervals(matrix, wanted)]
    if not pairs:
        return np.zeros(0), np.zeros((len(matrix), 0))
    values, vectors = np.concatenate([v for v, _ in pairs]), np.concatenate([u for _, u in pairs], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    # of the two signs the one with a positive largest entry
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))])
    return values, vectors


# --- sums over all vectors -------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def stepped(vector: Column) -> Column:
    """The vector in whole steps; entries beyond the range of a long become its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows; short ones are filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    rows = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    rows[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return rows


def _added(fit: DataFrame, dims: int, size: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``part`` over all vectors of the fit list, a matrix of ``size`` columns.

    A task adds up its vectors and hands on one row per line of the matrix;
    each line is then added up by itself.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column(0), dims))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"line": pa.array(range(len(total)), pa.int32()), "v": pa.array(list(total))})

    def whole(table: pa.Table) -> pa.Table:
        total = np.sum(table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, size), axis=0)
        return pa.table({"line": table.column("line")[:1], "v": pa.array([total])})

    schema = f"line int, v array<{kind}>"
    lines = fit.select("x").mapInArrow(partial, schema).groupBy("line").applyInArrow(whole, schema).collect()
    return np.array([row.v for row in sorted(lines)])


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with these sums; eigenvalues and unit eigenvectors (columns) of their covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean()) @ (self.vectors / np.sqrt(self.values))


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and the largest components of the distinct vectors of ``df``, in whole steps.

    Null vectors and those with null or non-finite entries are left out. Vectors
    that are shorter than the longest count as filled up with zeros. Without
    vectors, or where all are equal, there are no components. The driver holds
    matrices of dimension times dimension, never vectors.
    """
    rows = df.where(usable(F.col(vector_col))).select(stepped(F.col(vector_col)).alias("x"))
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    # equal when filled up: trailing zeros of short vectors are written out before repeats go
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    fit = written(rows.select(filled.alias("x")).distinct())
    n = fit.count() if dims else 0
    none = Whitening(n, (0,) * dims, np.zeros(0), np.zeros((dims, 0)), np.zeros(0), 0.0)
    if not n:
        return none

    halves = _added(fit, dims, dims, lambda x: np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), "long")
    sums = tuple((int(high) << 32) + int(low) for high, low in zip(*halves))
    mean = np.array([s / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = _added(fit, dims, dims, products) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = top_components(covariance, components)
    made = replace(none, sums=sums, values=values, vectors=vectors, explained=values / max(np.trace(covariance), _EPS))
    if not len(values):
        return made

    def whitened_products(x: np.ndarray) -> np.ndarray:
        white = made.whiten(x)  # centred: the mean is taken off before
        return white.T @ white

    white = _added(fit, dims, len(values), whitened_products) / n
    return replace(made, identity_error=float(np.abs(white - np.eye(len(values))).max()))


def whiten(df: DataFrame, model: Whitening, vector_col: str = "embedding", out: str = "whitened") -> DataFrame:
    """The rows of ``df`` whose vector is usable, with a struct ``out`` of ``deviation`` and ``whitened``.

    ``whitened`` is a list, one number per component. ``deviation`` is the exact
    squared distance to the mean, times the square of ``n``; null where a long
    cannot hold it. Repeated rows are whitened row by row; an empty table stays
    empty. Of vectors longer than those of the fit, the further entries count nothing.
    A column named ``out`` is replaced, all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<deviation:long,whitened:array<double>>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        told = shared.value
        # whole numbers wrap around alike on both sides, so their difference is right when it fits
        wrapped = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in told.sums], np.int64)
        about = np.array(told.sums, float)
        for lists in batches:
            x = _matrix(lists, len(told.sums))
            off = x * np.int64(told.n) - wrapped
            size = ((x * float(told.n) - about) ** 2).sum(1)
            exact = (off * off).sum(1)
            white = told.whiten(x) if len(told.values) else np.zeros((len(x), 0))
            deviation = pa.array(exact, mask=size >= 2.0**63)
            ends = pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32())
            listed = pa.ListArray.from_arrays(ends, pa.array(white.ravel()))
            yield pa.StructArray.from_arrays([deviation, listed], ["deviation", "whitened"])

    made = free_name(df, "__whitened")
    kept = [f"`{c}`" for c in df.columns if c.lower() != out.lower()]
    x = F.slice(stepped(F.col(vector_col)), 1, max(len(model.sums), 1))
    rows = df.where(usable(F.col(vector_col))).withColumn(made, apply(x))
    return rows.select(*kept, F.col(made).alias(out))
