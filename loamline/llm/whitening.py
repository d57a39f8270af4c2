"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed: one pass over the rows gives V Q for a narrow block Q, as the sum of Xc' (Xc Q) over
tasks. A Chebyshev recurrence over such passes damps the part of the spectrum that is not wanted, QR and Rayleigh-Ritz turn the
block into eigenvector estimates, and that repeats until the residuals of the wanted pairs certify them. Only blocks of
``dimensions x columns`` numbers reach the driver.

Defined results. Rows are left out whose vector is null, empty, holds null or non-finite entries, or is shorter than the longest
one (it lacks entries). Repeated rows and null ids count and come out each by itself. Without rows, or if all are equal, there is
nothing to whiten and the result is empty; components whose variance is zero to double precision are left out. Equal
eigenvalues get any basis of their space. A deviation that no long can hold is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize

#: Components returned, and columns that the block has beside them.
COMPONENTS, GUARD = 32, 16
#: Degree of the filter, and the residual, relative to the largest eigenvalue, that certifies a pair.
DEGREE, TOLERANCE = 12, 2e-14
#: How much further than the last wanted value a filter may raise the largest.
STEEP = 1e6
#: Filters applied at most before the block is made wider; a block of all dimensions is exact at once.
ROUNDS = 12
#: Partial sums that one task, or the driver, adds up at most.
FAN_IN = 64
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this are cut to it, so that scaling stays within a long.
LIMIT = float(1 << 50)


@dataclass(frozen=True)
class Whitening:
    """Rows ``n``, per-dimension sums, unit eigenvectors as columns by falling eigenvalue, and what was certified."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float

    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def integers(df: DataFrame, vector: str, into: str) -> DataFrame:
    """``df`` with the complete finite vectors as longs floor(64 c) + 1000000, in a written table."""
    good = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.where(good)
    longest = rows.agg(F.max(F.size(vector))).first()[0] or 0
    rows = rows.where((F.size(vector) == longest) & (F.size(vector) > 0))
    scaled = F.transform(vector, lambda c: F.floor(SCALE * F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double")))).cast("long") + SHIFT)
    return materialize(rows.withColumn(into, scaled), "integers")


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _total(rows: DataFrame, left: int, column: str, partial: Callable[[np.ndarray], np.ndarray], dtype: str) -> np.ndarray | None:
    """The sum of ``partial`` over the batches of ``column``: within tasks (``left`` of them), then over groups of tasks, then here.

    None without rows.
    """

    def added(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in parts:
            total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sum": pa.array([np.ascontiguousarray(total, dtype).tobytes()], pa.binary())})

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added(partial(_matrix(b.column(0))) for b in batches if b.num_rows)

    def of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return added(np.frombuffer(x.as_py(), dtype) for b in batches for x in b.column(0))

    sums = rows.select(column).mapInArrow(of_rows, "sum binary")
    while left > FAN_IN:
        left = math.ceil(left / FAN_IN)
        sums = sums.repartition(left).mapInArrow(of_sums, "sum binary")
    total = None
    for r in sums.collect():  # FAN_IN rows at most
        x = np.frombuffer(bytes(r[0]), dtype)
        total = x if total is None else total + x
    return total


def _first_sums(x: np.ndarray) -> np.ndarray:
    """Rows and per-dimension sums in longs; the bound on entries keeps a batch's sums within them."""
    return np.concatenate(([len(x)], x.sum(axis=0)))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n: the subtraction is of integers and exact."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**62:
        return (n * x - sums) / n
    return (x - sums // n) - (sums % n) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums over dimensions of (n x - S)^2, exact; None where no long holds them."""
    rough = (centred(x, n, sums) * n) ** 2
    if rough.size and float(rough.sum(axis=1).max()) < 2.0**62 and float(np.abs(x).max()) * n < 2.0**62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def fit(rows: DataFrame, column: str, *, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE) -> Whitening | None:
    """The leading eigenpairs of the covariance of ``column`` (lists of longs of one length); None without variance."""
    tasks = rows.rdd.getNumPartitions()
    first = _total(rows, tasks, column, _first_sums, "<i8")
    if first is None:
        return None
    n, sums = int(first[0]), first[1:].copy()
    d = len(sums)

    def times(q: np.ndarray) -> np.ndarray:
        """V q, by one pass over the rows."""

        def partial(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, sums)
            return (y.T @ (y @ q)).ravel()

        return _total(rows, tasks, column, partial, "<f8").reshape(d, -1) / n

    trace = float(_total(rows, tasks, column, lambda x: np.array([np.square(centred(x, n, sums)).sum()]), "<f8")[0]) / n
    if not trace > 0:
        return None
    width = min(d, components + guard)
    q, vq = np.linalg.qr(np.random.default_rng(1).standard_normal((d, width)))[0], None
    while True:
        q, vq, values, residual = _iterate(times, q, min(components, d), degree, tolerance)
        if residual <= tolerance * values[0] or width == d:
            break
        width = min(d, 2 * width)  # not certified: a wider block has a wider gap to what it leaves out
        q = np.linalg.qr(np.hstack((q, np.random.default_rng(width).standard_normal((d, width - q.shape[1])))))[0]
    kept = values[:components] > values[0] * d * np.finfo(float).eps
    vectors, values = q[:, :components][:, kept], values[:components][kept]
    p = vectors / np.sqrt(values)
    r = p.shape[1]

    def second(x: np.ndarray) -> np.ndarray:
        z = centred(x, n, sums) @ p
        return np.concatenate((z.sum(axis=0), (z.T @ z).ravel()))

    moments = _total(rows, tasks, column, second, "<f8") / n
    error = moments[r:].reshape(r, r) - np.outer(moments[:r], moments[:r]) - np.eye(r)
    return Whitening(n, sums, vectors, values, trace, residual, float(np.abs(error).max()))


def _iterate(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, wanted: int, degree: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Ritz vectors, V times them, Ritz values and the largest residual of the wanted pairs, after as many filters as it takes."""
    best = math.inf
    for round_ in range(ROUNDS + 1):
        vq = times(q)
        h = q.T @ vq
        values, u = np.linalg.eigh((h + h.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        settled = residual <= 100 * tolerance * values[0] and residual > best / 2  # at the floor of double arithmetic
        best = min(best, residual)
        if residual <= tolerance * values[0] or settled or round_ == ROUNDS or q.shape[0] == q.shape[1]:
            return q, vq, values, (min(residual, tolerance * values[0]) if settled else residual)
        q = np.linalg.qr(_filtered(times, q, vq, values, _degree(values, wanted, degree)))[0]
    raise AssertionError("unreachable")


def _degree(values: np.ndarray, wanted: int, most: int) -> int:
    """The degree at which the filter raises the largest value at most STEEP times as far as the last wanted one: beyond, rounding drowns that."""
    half = max(values[-1], values[0] * 1e-12) / 2
    reach = np.arccosh(np.maximum(1.0, (values[[0, wanted - 1]] - half) / half))
    return int(np.clip(math.log(STEEP) / max(reach[0] - reach[1], 1e-9), 2, most))


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, values: np.ndarray, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V, small on [0, the least Ritz value] and scaled to 1 at the largest, applied to q.

    The first of its ``degree`` products with V is the one that Rayleigh-Ritz has made.
    """
    top, edge = values[0], max(values[-1], values[0] * 1e-12)
    centre = half = edge / 2
    sigma = half / (centre - top)
    start = sigma
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / start - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def whitened(rows: DataFrame, column: str, model: Whitening | None, into: str) -> DataFrame:
    """``rows`` with ``into``: the deviation and the whitened coordinates of ``column``. Without a model there are no rows."""
    kind = "struct<deviation:bigint,whitened:array<double>>"
    if model is None:
        return rows.limit(0).withColumn(into, F.lit(None).cast(kind))

    @F.arrow_udf(kind)
    def project(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]))
        m = _matrix(x)
        z = centred(m, model.n, model.sums) @ model.projection()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
        return pa.StructArray.from_arrays([pa.array(deviations(m, model.n, model.sums), pa.int64()), lists], ["deviation", "whitened"])

    return rows.withColumn(into, project(column))
