"""Embedding whitening: covariance in Spark, eigenvectors by tridiagonal methods.

Fit, on all usable vectors: sums (exact, decimals in Spark), then the covariance
of the centred vectors, each as partial sums per task that Spark adds up, so
the driver sees one matrix of the dimension's size (at most ``MAX_DIM`` wide)
and no rows.  The matrix is brought to tridiagonal form by Householder
reflections; its leading eigenvalues come from bisection on Sturm counts, all
at once, and the components from inverse iteration on the tridiagonal matrix,
with vectors of close eigenvalues made orthogonal to each other, turned
back by the reflections.  Mean, components and eigenvalues are broadcast and
every vector is projected in numpy; the whitened rows are written once, and the
covariance of what was written gives the identity error.

Entries are taken on a grid: x = floor(1024 c) + 100000.

Edge cases: rows whose vector is null, or holds null or non-finite entries,
are dropped; a null id stays a row; repeated rows count and are projected
each time; vectors of another dimension are a fit of their own; an empty vector
has no component and so no row; entries beyond 2**52 in size count as that; a
component whose eigenvalue is zero (to rounding) has no whitened values and is
left out; equal eigenvalues (ties) give some orthonormal basis; ``deviation``
is null where it does not fit a long; an empty table gives an empty one;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialize, prepare

COMPONENTS = 8
GRID, SHIFT = 1024.0, 100_000
MAX_DIM = 4096                 # a covariance of this width is 0.13 GB; wider vectors raise
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, unit reflection vectors) of a symmetric matrix."""
    a, turns = a.copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size > 0:
            v[0] += np.copysign(size, v[0])
            v /= np.linalg.norm(v)
            p = a[k + 1:, k + 1:] @ v
            p -= (v @ p) * v
            a[k + 1:, k + 1:] -= 2 * (np.outer(v, p) + np.outer(p, v))
            a[k + 1, k] = a[k, k + 1] = -np.copysign(size, a[k + 1, k])
            a[k + 2:, k] = a[k, k + 2:] = 0
        turns.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), turns


def below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each ``x``."""
    tiny = np.finfo(float).tiny ** 0.5 * max(1.0, float(np.abs(e).max(initial=0)))
    q, count = np.ones(len(x)), np.zeros(len(x), int)
    for k in range(len(d)):
        q = d[k] - x - (e[k - 1] ** 2 / q if k else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` greatest eigenvalues, falling, by bisection."""
    reach = np.abs(np.append(e, 0)) + np.abs(np.append(0, e))
    count = min(count, len(d))
    low, high = np.full(count, (d - reach).min()), np.full(count, (d + reach).max())
    at_least = len(d) - np.arange(count)
    high += np.abs(high) * 1e-15 + np.finfo(float).tiny
    for _ in range(200):
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            break
        more = below(d, e, mid) >= at_least
        high, low = np.where(more, mid, high), np.where(more, low, mid)
    return low + (high - low) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solves (T - shift) x = b by elimination with row exchanges."""
    n = len(d)
    rows = np.zeros((n, 3))
    rows[:, 0], rows[:-1, 1], x = d - shift, e, b.copy()
    for k in range(n - 1):
        under = np.array([e[k], rows[k + 1, 0], rows[k + 1, 1]])
        if abs(under[0]) > abs(rows[k, 0]):
            rows[k], under = under, rows[k].copy()
            x[k], x[k + 1] = x[k + 1], x[k]
        if rows[k, 0] == 0:
            rows[k, 0] = least
        f = under[0] / rows[k, 0]
        rows[k + 1] = under[1] - f * rows[k, 1], under[2] - f * rows[k, 2], 0
        x[k + 1] -= f * x[k]
    for k in range(n - 1, -1, -1):
        if abs(rows[k, 0]) < least:
            rows[k, 0] = least
        s = x[k] - (rows[k, 1] * x[k + 1] if k + 1 < n else 0) - (rows[k, 2] * x[k + 2] if k + 2 < n else 0)
        x[k] = s / rows[k, 0]
        if abs(x[k]) > 1e150:
            x *= 1e-150
    return x


def components(v: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the covariance, falling;
    the largest entry of each vector is positive."""
    d, e, turns = tridiagonal(v)
    values = leading_values(d, e, count)
    scale = max(float(np.abs(d).max(initial=0)), float(np.abs(e).max(initial=0)))
    eps, rng = np.finfo(float).eps, np.random.default_rng(11)
    out, cluster = np.zeros((len(d), len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * scale:
            cluster = j
        x = rng.standard_normal(len(d))
        # equal eigenvalues are set apart a little, so that their solves differ
        shift = value - (j - cluster) * 4 * eps * scale
        for _ in range(6):
            for _ in range(2):
                x -= out[:, cluster:j] @ (out[:, cluster:j].T @ x)
            x /= np.linalg.norm(x)
            x = _solve(d, e, shift, x, eps * scale or 1.0)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, cluster:j] @ (out[:, cluster:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    for k in range(len(turns) - 1, -1, -1):
        out[k + 1:] -= 2 * np.outer(turns[k], turns[k] @ out[k + 1:])
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1.0, 1.0) if len(d) else 1
    return values, out


def grids(batch) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Of a batch (id, vector): rows by dimension, as (positions, grid values)."""
    import pyarrow as pa
    vectors = batch.column(1)
    flat, ends = vectors.flatten(), np.asarray(vectors.value_lengths().fill_null(0)).astype(np.int64)
    good = np.ones(len(vectors), bool)
    good[np.flatnonzero(np.asarray(vectors.is_null()))] = False
    values = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")))
    row = np.repeat(np.arange(len(vectors)), ends)
    good[row[~np.isfinite(values)]] = False
    start, out = np.cumsum(ends) - ends, {}
    for dim in np.unique(ends[good]).tolist():
        at = np.flatnonzero(good & (ends == dim))
        x = values[start[at][:, None] + np.arange(dim)]
        out[dim] = at, np.clip(np.floor(GRID * x), -2.0 ** 52, 2.0 ** 52).astype(np.int64) + SHIFT
    return out


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dimension -> (n, exact sums): a row per dimension and place."""
    import pyarrow as pa

    def run(batches):
        held = {}
        for b in batches:
            for dim, (at, x) in grids(b).items():
                n, s = held.get(dim, (0, 0))
                small = int(np.abs(x).max(initial=0)) * len(at) < 1 << 62
                held[dim] = n + len(at), s + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
        for dim, (n, s) in held.items():
            s = list(s) if dim else [0]
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array([n] * len(s), pa.int64()),
                                              pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], names=["dim", "i", "n", "s"])

    got: dict[int, tuple[int, list[int]]] = {}
    parts = rows.mapInArrow(run, "dim int, i int, n long, s decimal(38,0)").groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    for r in parts.orderBy("dim", "i").collect():
        if r.dim > MAX_DIM:
            raise ValueError(f"vectors of more than {MAX_DIM} entries")
        if r.dim:
            got.setdefault(r.dim, (r.n, []))[1].append(int(r.s))
    return got


def _covariance(rows: DataFrame, mean: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Sums of products of the centred vectors, by dimension."""
    import pyarrow as pa

    def run(batches):
        held = {}
        for b in batches:
            for dim, (_, x) in grids(b).items():
                if dim:
                    y = x - mean[dim]
                    held[dim] = held.get(dim, 0) + y.T @ y
        for dim, c in held.items():
            for i in range(dim):
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([i], pa.int32()), pa.array([c[i, i:].tolist()])], names=["dim", "i", "row"])

    parts = rows.mapInArrow(run, "dim int, i int, row array<double>").select("dim", "i", F.posexplode("row").alias("j", "v"))
    total = parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).orderBy("dim", "i", "j").toArrow()
    dims, v = total.column("dim").to_numpy(), total.column("v").to_numpy()
    out = {}
    for dim in np.unique(dims).tolist():
        c = np.zeros((dim, dim))
        c[np.triu_indices(dim)] = v[dims == dim]
        out[dim] = c + np.triu(c, 1).T
    return out


class Whitener:
    """Mean and scaled components of the vectors of one dimension."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, count: int):
        self.n, self.sums = n, sums
        v = products / n
        values, vectors = components(v, count)
        real = values > max(float(values[0]) * len(v) * np.finfo(float).eps, 1e-100)
        self.mean = mean_of(n, sums)
        self.axes = vectors[:, real] / np.sqrt(values[real])
        self.explained = values[real] / np.trace(v) if real.any() else values[real]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum((n x - S)^2) of each row, exact."""
        if max(self.n * max(abs(int(x.min())), abs(int(x.max()))), *map(abs, self.sums)) < 1 << 62:
            d = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(d).max()) ** 2 * x.shape[1] < 1 << 63:
                return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return [s if s < 1 << 63 else None for s in map(int, (d * d).sum(axis=1))]


def mean_of(n: int, sums: list[int]) -> np.ndarray:
    """S / n, correctly rounded."""
    return np.array([s / n for s in sums])


def fit(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener per dimension, from all usable vectors."""
    prepare(df.sparkSession)
    rows = df.select(F.lit(None).cast("long").alias("i"), col(vector).alias("v"))
    sums = _sums(rows)
    products = _covariance(rows, {d: mean_of(*s) for d, s in sums.items()})
    return {d: Whitener(n, s, products[d], count) for d, (n, s) in sums.items()}


def transform(df: DataFrame, fitted: dict[int, Whitener], vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, deviation, whitened) of each usable row; whitened is the
    array of its components."""
    import pyarrow as pa
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        for b in batches:
            for dim, (at, x) in grids(b).items():
                w = shared.value.get(dim)
                if w is not None:
                    z = (x - w.mean) @ w.axes
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)), pa.array(w.deviations(x), pa.int64()),
                                                      pa.array(z.tolist(), pa.list_(pa.float64()))], names=["vec_id", "dim", "deviation", "whitened"])

    rows = df.select(col(vec_id).cast("long").alias("i"), col(vector).alias("v"))
    return rows.mapInArrow(run, "vec_id long, dim int, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, dim: int, k: int) -> float:
    """Largest entry of the covariance of whitened rows minus the identity."""
    z = [F.col("whitened")[i] for i in range(k)]
    own = rows.where(F.col("dim") == dim)
    mean = own.agg(*[F.avg(c) for c in z]).first()
    y = [c - F.lit(m) for c, m in zip(z, mean, strict=True)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = own.agg(*[F.avg(y[i] * y[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs, strict=True))


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    fitted = fit(df, vector, count)
    rows = materialize(transform(df, fitted, vec_id, vector), "whitened")
    out = None
    for dim, w in sorted(fitted.items()):
        k = w.axes.shape[1]
        if k:
            own = rows.where(F.col("dim") == dim).select("vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
            part = own.select("vec_id", (F.col("c") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                              F.element_at(F.array(*[F.lit(float(x)) for x in w.explained]), F.col("c") + 1).alias("explained"),
                              F.lit(identity_error(rows, dim, k)).alias("identity_error"))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else df.sparkSession.createDataFrame([], OUT)
