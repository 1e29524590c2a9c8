"""Principal components of vectors by incremental eigendecomposition, and whitening.

Every task holds the spectrum of what it has read: count, mean, eigenvalues of the scatter matrix
and their vectors. A vector is one centred rank-one update: its part outside the basis becomes a
new direction, entries of no weight and equal eigenvalues are deflated, the rest are the roots of
the secular equation, and the vectors follow from weights that fit those roots exactly, so that the
basis stays orthogonal. Two spectra combine by as many rank-one updates as the second has
eigenvalues, and one for the difference of the means; tasks' spectra meet in groups.

The last basis is refined by Rayleigh-Ritz passes over the data: covariance times basis, summed by
tasks with the exact mean, until the residual of the wanted components is of rounding size. Where
the basis is whole (up to RANK dimensions) the first pass ends it.

Defined results: the fit list holds each distinct vector once; components without variance are left
out, so that a single distinct vector, or an empty table, gives no row. See `whole_vectors` for rows
that take no part. Eigenvectors point so that their largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stored
from .vectors import matrix

#: Directions that a spectrum keeps; with fewer dimensions it is whole.
RANK = 128
#: Groups in which the tasks' sums meet, level by level, before the driver adds the last ones.
FAN_IN = (256, 16)
#: Relative size under which weights and gaps of eigenvalues are deflated. The refinement mends what is lost.
DEFLATE = 1e-12
#: Passes of refinement, and the residual that ends them, as a share of the largest eigenvalue.
PASSES, RESIDUAL = 40, 2e-14


# rank-one updates ---------------------------------------------------------------------------


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)), poles ascending and apart, weights positive.

    Returns the roots and the matrix poles[j] - root[i], computed from the nearer pole so that
    close differences keep their digits. A root lies between its pole and the next, the last one
    below the last pole and the sum of the weights.
    """
    n = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum() * (1 + 1e-15))
    middle = (poles + ends) / 2
    right = (1 + (weights / (poles - middle[:, None])).sum(1)) < 0
    right[-1] = False
    origin = np.where(right, ends, poles)
    near = poles - origin[:, None]
    low = np.where(right, middle - origin, 0.0)
    high = np.where(right, 0.0, np.where(np.arange(n) == n - 1, ends - origin, middle - origin))
    gap, upper = ends - poles, np.triu(np.ones((n, n)), 1)
    x = (low + high) / 2
    for _ in range(60):
        apart = near - x[:, None]
        apart[apart == 0] = np.finfo(float).tiny
        terms = weights / apart
        value = 1 + terms.sum(1)
        settled = np.abs(value) <= 1e-9 * (1 + np.abs(terms).sum(1))
        if settled.all():
            break
        positive = value > 0
        high, low = np.where(positive, x, high), np.where(positive, low, x)
        slopes = terms / apart
        after = (slopes * upper).sum(1)
        before = slopes.sum(1) - after
        # Value and slopes of either side fit c + s / (pole - x) + t / (next pole - x): a quadratic
        # in the distance from the nearer pole, and for the last root one pole alone.
        d1 = np.where(right, -gap, 0.0) - x
        d2 = d1 + gap
        c = value - before * d1 - after * d2
        s, t = before * d1**2, after * d2**2
        with np.errstate(all="ignore"):
            b = np.where(right, s + t - c * gap, s + t + c * gap)
            product = np.where(right, -t, s) * gap
            root = np.sqrt(np.maximum(b * b - 4 * c * product, 0))
            guess = np.where(b > 0, 2 * product / (b + root), (b - root) / (2 * c))
            guess[-1] = s[-1] / (value[-1] - before[-1] * d1[-1])
        inside = np.isfinite(guess) & (guess > low) & (guess < high)
        x = np.where(settled, x, np.where(inside, guess, (low + high) / 2))
    apart = near - x[:, None]
    apart[apart == 0] = np.finfo(float).tiny
    return origin + x, apart


def rank_one(values: np.ndarray, basis: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of basis (diag(values) + rho z z') basis'; rho > 0."""
    values, z = values.copy(), z.copy()
    size = float(np.sqrt(z @ z))
    scale = max(float(values[-1]), rho * size * size)
    live = np.flatnonzero(rho * np.abs(z) * size > DEFLATE * scale)
    if len(live) > 1 and np.any(np.diff(values[live]) <= DEFLATE * scale):
        basis, kept = basis.copy(), []
        for i, j in zip(live, [*live[1:], None]):
            if j is None or values[j] - values[i] > DEFLATE * scale:
                kept.append(i)
                continue
            r = float(np.hypot(z[i], z[j]))  # turn the pair so that only the second has weight
            c, s = z[j] / r, z[i] / r
            basis[:, i], basis[:, j] = c * basis[:, i] - s * basis[:, j], s * basis[:, i] + c * basis[:, j]
            z[i], z[j] = 0.0, r
        live = np.array(kept)
    if len(live) == 0:
        return values, basis
    poles, weights = values[live], rho * z[live] ** 2
    if len(live) == 1:
        values[live] = poles + weights
    else:
        roots, apart = secular_roots(poles, weights)
        gaps = poles - poles[:, None]
        np.fill_diagonal(gaps, 1.0)
        fitted = np.sqrt(np.abs(np.prod(apart / gaps, axis=0))) * np.sign(z[live])
        vectors = fitted / apart
        vectors /= np.sqrt((vectors * vectors).sum(1))[:, None]
        basis = basis.copy()
        basis[:, live] = basis[:, live] @ vectors.T
        values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, exact sums, mean, and the largest eigenvalues (ascending) and vectors of the scatter."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d, np.int64), np.zeros(d), np.zeros(0), np.zeros((d, 0)))

    def _update(self, direction: np.ndarray, rho: float) -> None:
        z = self.basis.T @ direction
        if len(self.values) < len(direction):
            rest = direction - self.basis @ z
            rest -= self.basis @ (self.basis.T @ rest)
            size = float(np.sqrt(rest @ rest))
            if size > 1e-10 * float(np.sqrt(direction @ direction)):
                self.basis = np.column_stack([rest / size, self.basis])
                self.values, z = np.append(0.0, self.values), np.append(size, z)
        if len(z) and float(z @ z) > 0 and rho > 0:
            self.values, self.basis = rank_one(self.values, self.basis, z, rho)
        if len(self.values) > RANK:
            self.values, self.basis = self.values[-RANK:], self.basis[:, -RANK:]

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self._update(away, self.n / (self.n + 1))
        self.n += 1
        self.sums += x
        self.mean = self.mean + away / self.n

    def absorb(self, other: Spectrum) -> None:
        if other.n == 0:
            return
        if self.n == 0:
            self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.basis.T):
            self._update(vector, float(value))
        self._update(other.mean - self.mean, self.n * other.n / (self.n + other.n))
        self.n, self.sums = self.n + other.n, self.sums + other.sums
        self.mean = self.sums / self.n


# sums over tasks ----------------------------------------------------------------------------

_SUMMARY = "part bigint, n bigint, sums array<bigint>, numbers array<double>"
_ARROW = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("numbers", pa.list_(pa.float64()))])


def _row(part: int, n: int, sums: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int64()), pa.array([n], pa.int64())]
    columns += [pa.array([v.ravel().tolist()], kind.type) for v, kind in zip((sums, numbers), list(_ARROW)[2:])]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _gathered(summaries: DataFrame, merged: Callable[[list[dict]], tuple[int, np.ndarray, np.ndarray]]) -> list[dict]:
    """One summary a task, merged in groups level by level; the last few come to the driver."""
    def meeting(groups: int) -> Callable[[pa.Table], pa.Table]:
        def merge(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["part"])
            return pa.Table.from_batches([_row(rows[0]["part"] % groups, *merged(rows))])

        return merge

    for groups in FAN_IN:
        summaries = summaries.groupBy((F.col("part") % groups).alias("group")).applyInArrow(meeting(groups), _SUMMARY)
    return sorted((row.asDict() for row in summaries.collect()), key=lambda r: r["part"])


def _part() -> int:
    return TaskContext.get().partitionId()


def _unpacked(row: dict) -> Spectrum:
    sums, numbers = np.array(row["sums"], np.int64), np.array(row["numbers"])
    d = len(sums)
    rank = (len(numbers) - d) // (d + 1) if d else 0
    return Spectrum(row["n"], sums, numbers[:d], numbers[d : d + rank], numbers[d + rank :].reshape(d, rank))


def _packed(s: Spectrum) -> tuple[int, np.ndarray, np.ndarray]:
    return s.n, s.sums, np.concatenate([s.mean, s.values, s.basis.ravel()])


def _combined(rows: list[dict]) -> Spectrum:
    spectra = [_unpacked(row) for row in rows]
    whole = spectra[0]
    for spectrum in spectra[1:]:
        whole.absorb(spectrum)
    return whole


def spectrum(fit: DataFrame) -> Spectrum | None:
    """Spectrum of the vectors `x`, none of an empty table."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for x in matrix(batch):
                own = own or Spectrum.empty(len(x))
                own.add(x)
        if own:
            yield _row(_part(), *_packed(own))

    rows = _gathered(fit.select("x").mapInArrow(task, _SUMMARY), lambda group: _packed(_combined(group)))
    return _combined(rows) if rows else None


def _summed(rows: list[dict]) -> tuple[int, np.ndarray, np.ndarray]:
    return sum(r["n"] for r in rows), np.zeros(0, np.int64), np.sum([r["numbers"] for r in rows], axis=0)


def _total(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of what `of` makes of each batch of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = None, 0
        for batch in batches:
            if batch.num_rows:
                made = of(matrix(batch))
                own, n = made if own is None else own + made, n + batch.num_rows
        if own is not None:
            yield _row(_part(), n, np.zeros(0, np.int64), own)

    return _summed(_gathered(fit.select("x").mapInArrow(task, _SUMMARY), _summed))[2]


@dataclass
class Components:
    """The leading components of the fit list, and what whitening needs of it."""

    n: int
    sums: np.ndarray
    values: np.ndarray  # falling
    vectors: np.ndarray  # a column each
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.vectors / np.sqrt(self.values)


def refined(fit: DataFrame, first: Spectrum, top: int) -> Components:
    """The `top` leading eigenpairs of the covariance, by Rayleigh-Ritz passes from the spectrum's basis."""
    mean, n, d = first.sums / first.n, first.n, len(first.sums)
    basis, _ = np.linalg.qr(first.basis[:, ::-1])
    for _ in range(PASSES):

        def product(x: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
            away = x - mean
            return np.append((away.T @ (away @ basis)).ravel(), (away * away).sum())

        total = _total(fit, product) / n
        image, trace = total[:-1].reshape(d, -1), float(total[-1])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors = basis @ turn
        wanted = slice(0, top)
        off = image @ turn[:, wanted] - vectors[:, wanted] * values[wanted]
        if basis.shape[1] in (0, d) or np.sqrt((off * off).sum(0)).max() <= RESIDUAL * max(values[0], 0) * np.sqrt(d):
            break
        basis, _ = np.linalg.qr(image @ turn)
    keep = int((values[wanted] > 1e-13 * max(trace, 0)).sum()) if trace > 0 else 0
    values, vectors = values[:keep], vectors[:, :keep]
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    largest = np.abs(vectors).argmax(0) if keep else np.zeros(0, int)
    return Components(n, first.sums, values, vectors * np.sign(vectors[largest, np.arange(keep)]), trace)


def identity_error(fit: DataFrame, found: Components) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(found.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.whiten(x)
        return np.append((w.T @ w).ravel(), w.sum(0))

    total = _total(fit, moments) / found.n
    covariance = total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :])
    return float(np.abs(covariance - np.eye(k)).max())


def fit(vectors: DataFrame, top: int = 4) -> tuple[Components, float] | None:
    """Components of the distinct vectors `x` and the error of their whitening; none without variance."""
    distinct = stored(vectors.select("x").distinct())
    first = spectrum(distinct)
    if first is None or len(first.values) == 0:
        return None
    found = refined(distinct, first, top)
    return (found, identity_error(distinct, found)) if len(found.values) else None


def whitened(vectors: DataFrame, found: Components) -> DataFrame:
    """(vec_id, x, whitened): every row projected on the components, each over its deviation."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = pa.array(found.whiten(matrix(batch)).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), rows], ["vec_id", "x", "whitened"])

    return vectors.select("vec_id", "x").mapInArrow(task, "vec_id bigint, x array<bigint>, whitened array<double>")
