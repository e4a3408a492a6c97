"""Embedding whitening with principal components from FEAST contour integration.

Entries become integers, so every sum over the rows is exact: Spark adds up the
entries and, in a second pass, the products of entries centred by the rounded
mean; the rounding's remainder is taken off in integers.  The covariance does
not depend on how rows are spread.  Each task sends one number per pair of
dimensions, and a partial aggregate adds them; the driver holds matrices of the
vectors' length only.

The covariance V is solved by slices of its spectrum.  The inertia of V - sI (of
its tridiagonal form, by Sylvester's law) counts the eigenvalues above s, and
bisection on s puts a slice's ends into gaps.  A slice is solved by FEAST: a
Gauss-Legendre rule on a circle around it, one complex solve with zI - V for each
node, projects a block of vectors onto its eigenvectors; Rayleigh-Ritz takes
eigenpairs from the block, and again until the residuals are at rounding level.
A slice with fewer pairs than the inertia counts is solved again with a larger
block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import stage

#: Nodes of the quadrature rule on a half circle; the other half is the conjugate.
NODES = 8
#: Eigenvalues that one slice aims at, at most.
SLICE = 24
#: Eigenvalues below this share of the largest one are zero by rounding and name no component.
ZERO = 1e-12
#: Rows whose products are added up in doubles before they go into whole numbers, and bits of a limb:
#: 2 ** (2 * LIMB) * ROWS stays below 2 ** 53.
ROWS, LIMB = 2048, 20


# ------------------------------------------------------------ eigenpairs
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the symmetric ``a``, by Householder reflections."""
    a = np.array(a, float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        a[k + 1:] -= 2 * np.outer(x, x @ a[k + 1:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], s: float) -> int:
    """Eigenvalues above ``s``: the positive pivots of the shifted tridiagonal matrix."""
    least = np.finfo(float).tiny
    above, q, before = 0, 1.0, 0.0
    for i, x in enumerate(tri[0].tolist()):
        q = x - s - (before * before / q if i else 0.0)
        if abs(q) < least:
            q = -least
        above += q > 0
        before = float(tri[1][i]) if i < len(tri[1]) else 0.0
    return above


def _edge(tri, low: float, high: float, k: int, close: float) -> tuple[float, float]:
    """(a, b): the k-th largest eigenvalue lies in (a, b], found to ``close``."""
    while high - low > close:
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if count_above(tri, mid) >= k:
            low = mid
        else:
            high = mid
    return low, high


def feast(a: np.ndarray, low: float, high: float, count: int, found: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of symmetric ``a`` with eigenvalues in (low, high), falling; vectors in columns.

    Those in the columns of ``found``, from other slices, are projected out.
    """
    d = len(a)
    node, weight = np.polynomial.legendre.leggauss(NODES)
    angle = -np.pi / 2 * (node - 1)
    mid, radius = (low + high) / 2, (high - low) / 2
    shifts = mid + radius * np.exp(1j * angle)
    scale = max(np.abs(a).max(), np.finfo(float).tiny)
    free = d - found.shape[1]
    size = min(free, 2 * count + 8)
    while True:
        block = np.random.default_rng(seed).standard_normal((d, size))
        last = np.inf
        for _ in range(60):
            q = np.zeros((d, size))
            for z, w, t in zip(shifts, weight, angle):
                solved = np.linalg.solve(z * np.eye(d) - a, block)
                q += 0.5 * w * radius * np.real(np.exp(1j * t) * solved)
            q, _ = np.linalg.qr(q - found @ (found.T @ q))
            q, _ = np.linalg.qr(q - found @ (found.T @ q))  # again: the first pass leaves rounding where q was small
            small = q.T @ a @ q
            values, u = np.linalg.eigh((small + small.T) / 2)
            block = q @ u
            inside = np.flatnonzero((values > low) & (values < high))
            rest = np.abs(a @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0.0) / scale
            if len(inside) == count and (rest < 4e-15 or rest >= last / 2 and rest < 1e-11):
                order = inside[::-1]
                return values[order], block[:, order]
            last = rest
        if size == free:
            raise ArithmeticError(f"{len(inside)} eigenpairs found between {low} and {high}, the inertia counts {count}")
        size = min(free, 2 * size)


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a covariance (fewer if others are zero) and their unit vectors in columns."""
    tri = tridiagonal(v)
    radius = np.abs(np.concatenate([tri[1], [0]])) + np.abs(np.concatenate([[0], tri[1]]))
    top = float((tri[0] + radius).max()) if len(v) else 0.0
    if top <= 0:
        return np.zeros(0), np.zeros((len(v), 0))
    top *= 1 + 1e-9
    largest = _edge(tri, 0.0, top, 1, top * 1e-3)[1]
    k = min(k, count_above(tri, largest * ZERO))
    values, vectors, done, high = [], [], 0, top
    while done < k:
        aim = min(k, done + SLICE)
        close = high * 1e-9
        above, _ = _edge(tri, 0.0, high, aim, close)
        n = count_above(tri, above)  # ties and close neighbours of the last one come along
        below = _edge(tri, 0.0, above, n + 1, close)[1] if n < len(v) and above > 0 else 0.0
        low = (above + below) / 2 if n < len(v) else above / 2
        n = count_above(tri, low)
        e, p = feast(v, low, high, n - done, np.concatenate([np.zeros((len(v), 0)), *vectors], axis=1))
        values.append(e)
        vectors.append(p)
        done, high = n, low
    if not values:
        return np.zeros(0), np.zeros((len(v), 0))
    return np.concatenate(values)[:k], np.concatenate(vectors, axis=1)[:, :k]


# ------------------------------------------------------------ whole rows
def integer_vectors(rows: DataFrame, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, x): floor(scale * entry) + offset as longs, for the rows that stay.

    Rows go whose vector is null or empty, holds a null or an entry that is not
    finite, or one so large that x is no long.  Of vectors of several lengths
    those of the commonest one stay (the longest of equally common ones).
    """
    v = F.col("embedding")
    def usable(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double") * scale) < F.lit(2.0 ** 61), F.lit(False))
    sound = rows.select("vec_id", v.alias("embedding")).where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, usable))
    x = sound.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + F.lit(offset)).alias("x"))
    length = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return x.where(F.size("x") == (length["d"] if length else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _sums(fit: DataFrame) -> dict[int, int]:
    """Sum per dimension, and the number of rows under -1."""
    def each(batches):
        total, n = None, 0
        for batch in batches:
            if len(batch):
                m = _matrix(batch)
                part = [int(high) * 2 ** 31 + int(low) for high, low in zip((m // 2 ** 31).sum(axis=0), (m % 2 ** 31).sum(axis=0))]
                total = part if total is None else [a + b for a, b in zip(total, part)]
                n += len(batch)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([str(n), *map(str, total)])], ["i", "s"])
    parts = fit.select("x").mapInArrow(each, "i int, s string")
    return {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}


def _products(fit: DataFrame, shift: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums of y and of y y^T for y = x - shift."""
    d = len(shift)
    upper = np.triu_indices(d + 1)

    def each(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                y = _matrix(batch.slice(at, ROWS)) - shift
                limbs, rest = [], np.concatenate([y, np.ones((len(y), 1), np.int64)], axis=1)
                while rest.any():
                    low = (rest + (1 << LIMB - 1)) % (1 << LIMB) - (1 << LIMB - 1)
                    limbs.append(low.astype(float))
                    rest = (rest - low) >> LIMB
                for p, a in enumerate(limbs):
                    for q, b in enumerate(limbs):
                        dot = (a.T @ b).astype(np.int64).astype(object)
                        total[p + q] = total[p + q] + dot if p + q in total else dot
        for level, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                              pa.array(np.full(len(upper[0]), level, np.int32)), pa.array([str(v) for v in t[upper]])],
                                             ["i", "j", "level", "s"])
    parts = fit.select("x").mapInArrow(each, "i int, j int, level int, s string")
    got = parts.groupBy("i", "j", "level").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = [[0] * (d + 1) for _ in range(d + 1)]
    for r in got:
        out[r.i][r.j] += int(r.s) << (LIMB * r.level)
    for i in range(d + 1):
        for j in range(i):
            out[i][j] = out[j][i]
    return out[d][:d], [row[:d] for row in out[:d]]


@dataclass
class Whitening:
    """A fitted transformation: what a task needs, and what the fit was measured by."""
    n: int
    shift: np.ndarray        # rounded mean of each dimension
    rest: list[int]          # S - n * shift
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # unit eigenvectors in columns
    trace: float
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of x, centred and projected, at unit variance."""
        y = (x - self.shift).astype(float) - np.array([r / self.n for r in self.rest])
        return y @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S) ** 2, exact; null beyond a long."""
        y = x - self.shift
        largest = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest), default=0)
        if largest ** 2 * max(1, y.shape[1]) < 2 ** 63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in y.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]


def fit_whitening(x: DataFrame, components: int = 16) -> Whitening | None:
    """Fits on the distinct vectors of ``x`` (vec_id, x); None without rows."""
    fit = stage(x.select("x").distinct(), "vectors")
    sums = _sums(fit)
    if not sums:
        return None
    n = sums.pop(-1)
    shift = [(2 * sums[i] + n) // (2 * n) for i in range(len(sums))]
    rest = [sums[i] - n * m for i, m in enumerate(shift)]
    y, yy = _products(fit, np.array(shift, np.int64))
    v = np.array([[(n * yy[i][j] - y[i] * y[j]) / n ** 2 for j in range(len(y))] for i in range(len(y))])
    values, vectors = leading_eigenpairs(v, components)
    model = Whitening(n, np.array(shift, np.int64), rest, values, vectors, float(np.trace(v)))
    model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit rows' covariance minus the identity; whitened rows are centred already."""
    k = len(model.values)
    if not k:
        return 0.0
    upper = np.triu_indices(k + 1)

    def each(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if len(batch):
                w = model.whiten(_matrix(batch))
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])],
                                         ["i", "j", "s"])
    got = fit.select("x").mapInArrow(each, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((k + 1, k + 1))
    for r in got:
        m[r.i, r.j] = m[r.j, r.i] = r.s / model.n
    return float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max())


def whitened(rows: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    ``rows`` has vec_id and embedding; which rows are usable says
    ``integer_vectors``.  The fit counts equal vectors once; repeated rows and
    null ids are all returned.  Components whose eigenvalue is zero have no
    whitened values and are left out, so one distinct vector, or an empty table,
    gives no rows.  Other columns are ignored.
    """
    x = integer_vectors(rows)
    schema = T.StructType([x.schema["vec_id"], *[T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))]])
    model = fit_whitening(x, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)

    def each(batches):
        k = len(model.values)
        for batch in batches:
            if not len(batch):
                continue
            m, count = _matrix(batch), len(batch) * k
            at = pa.array(np.repeat(np.arange(len(batch)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                pa.array(np.full(count, model.n)), pa.array(model.deviation(m), pa.int64()).take(at), pa.array(model.whiten(m).ravel()),
                pa.array(np.tile(model.values / model.trace, len(batch))), pa.array(np.full(count, model.identity_error))], schema.fieldNames())

    return x.mapInArrow(each, schema)
