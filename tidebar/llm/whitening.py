"""Whitening of embeddings: components of their covariance, and each row's projection on them.

Four looks at the rows, each a narrow scan: lengths, exact sums, the centred covariance, the
covariance of the result. Every task adds up its own rows, Spark adds up the tasks; the driver
holds one matrix of d x d doubles (d is a vector's length), never rows. There its
leading eigenvalues come from Householder tridiagonalisation and bisection on Sturm
counts, its eigenvectors from inverse iteration; they are broadcast for the projection.

Entries are integers, and each is centred by the floor of its dimension's mean, so products are
integers too and their sums are exact up to 2^53: results don't depend on
how rows are spread over tasks.

Edge cases: rows whose vector is null or empty, holds null or non-finite entries, or has another
length than most rows have (of equally many, the greater) are dropped. Repeated rows count and are
returned each; a null id is kept. Entries beyond 2^40 count as that bound. A component
without variance has a null ``whitened`` and doesn't enter ``identity_error``; a deviation that a long can't hold is
null. An empty table gives no rows; further columns are ignored. Ties of
eigenvalues are broken by the order in which bisection finds them, their vectors are orthogonal. Long vectors need d x d doubles in each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SCALE, OFFSET = 1024, 100_000
N_COMPONENTS = 8
#: Entries' bound after scaling.
BOUND = 1 << 50
#: Rows multiplied at once.
BLOCK = 4096


# ---- eigenvalues of a symmetric matrix --------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Householder's reduction: (diagonal, subdiagonal, reflectors) of a matrix similar to ``a``."""
    a = a.astype(float).copy()
    n, mirrors = len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.abs(x).max()
        if size == 0 or not np.any(x[1:]):
            continue
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        x -= 2 * (v @ x) * v
        a[k, k + 1 :] = x
        mirrors.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(d: np.ndarray, e2: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: negative terms of the Sturm sequence."""
    below = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i in range(len(d)):
        q = d[i] - at - (e2[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues by falling value, all of them bisected at once to the last bit."""
    n = len(d)
    reach = np.abs(np.concatenate([[0], e])) + np.abs(np.concatenate([e, [0]]))
    lo, hi = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    norm = max(abs(lo[0]), abs(hi[0]), np.finfo(float).tiny)
    lo, hi = lo - norm * 1e-14, hi + norm * 1e-14
    wanted = n - np.arange(k)  # so many eigenvalues are below a point beyond the one sought
    least = np.finfo(float).tiny + (np.finfo(float).eps ** 2) * norm
    for _ in range(200):
        mid = (lo + hi) / 2
        if np.all((mid <= lo) | (mid >= hi)):
            break
        under = sturm_counts(d, e**2, mid, least) >= wanted
        lo, hi = np.where(under, lo, mid), np.where(under, mid, hi)
    return (lo + hi) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with partial pivoting."""
    n = len(d)
    main, up, up2, b = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    low = e
    for i in range(n - 1):
        if abs(low[i]) > abs(main[i]):  # swap rows i and i + 1
            f = main[i] / low[i]
            main[i], main[i + 1], up[i], up2[i], up[i + 1] = low[i], up[i] - f * main[i + 1], main[i + 1], up[i + 1], -f * up[i + 1]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
        else:
            f = low[i] / main[i] if main[i] else 0.0
            main[i + 1] -= f * up[i]
            b[i + 1] -= f * b[i]
        if abs(main[i]) < least:
            main[i] = least
    if abs(main[-1]) < least:
        main[-1] = least
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < n else 0) - (up2[i] * x[i + 2] if i + 2 < n else 0)) / main[i]
    return x


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (rows) for ``values`` by inverse iteration; those of a cluster are made orthogonal at each step."""
    n, rng, out = len(d), np.random.default_rng(1), []
    norm = max(np.abs(d).max() + 2 * (np.abs(e).max() if len(e) else 0), np.finfo(float).tiny)
    eps, start, shift = np.finfo(float).eps, 0, 0.0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            start = j  # a new cluster
        # equal eigenvalues get shifts that differ a little, downwards
        shift = min(value, shift - 10 * eps * norm) if j > start else value
        x = rng.standard_normal(n)
        for _ in range(6):
            x = _solve(d, e, shift, x / np.linalg.norm(x), eps * norm)
            for _ in range(2):
                for other in out[start:j]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out)


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as rows) of the k greatest eigenvalues of a symmetric matrix, by falling value."""
    k = min(k, len(a))
    if not np.any(a):
        return np.zeros(k), np.eye(len(a))[:k]
    d, e, mirrors = tridiagonal(a)
    values = leading_eigenvalues(d, e, k)
    vectors = eigenvectors(d, e, values)
    for at, v in reversed(mirrors):
        vectors[:, at:] -= 2 * np.outer(vectors[:, at:] @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.maximum(values, 0), vectors


# ---- sums over the rows ------------------------------------------------------


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    """x of a batch of whole vectors of length d."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
    return np.clip(np.floor(SCALE * flat), -BOUND, BOUND).astype(np.int64) + OFFSET


def _summed(rows: DataFrame, d: int, width: int, kernel: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``kernel(block of x)``, ``width`` numbers, over all blocks of all rows: each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _vectors(b.column(0), d)
            for at in range(0, len(x), BLOCK):
                part = kernel(x[at : at + BLOCK])
                total = part if total is None else total + part
        if total is not None:
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            values = pa.array(total, kind)
            empty = pa.nulls(len(total), pa.float64() if kind == pa.int64() else pa.int64())
            pair = [values, empty] if kind == pa.int64() else [empty, values]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *pair], names=["at", "whole", "part"])

    out = np.zeros(width)
    exact = [0] * width
    is_whole = False
    parts = rows.select("__v").mapInArrow(run, "at long, whole long, part double")
    for r in parts.groupBy("at").agg(F.sum("whole").alias("whole"), F.sum("part").alias("part")).collect():
        if r.whole is not None:
            exact[r.at], is_whole = r.whole, True
        else:
            out[r.at] = r.part
    return exact if is_whole else out


def usable(df: DataFrame, vector_col: str) -> tuple[DataFrame, int, int]:
    """(rows with whole vectors of the commonest length as ``__v``, that length, their number)."""
    v = F.col(vector_col)
    fit = df.withColumn("__v", v.cast("array<double>")).where(
        v.isNotNull() & (F.size(v) > 0) & F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    most = fit.groupBy(F.size("__v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not most:
        return fit, 0, 0
    return fit.where(F.size("__v") == most[0]["d"]), most[0]["d"], most[0]["count"]


class Fit:
    """Means, components and how much each explains."""

    def __init__(self, rows: DataFrame, d: int, n: int, k: int = N_COMPONENTS):
        self.n, self.d = n, d
        self.sums = [int(s) for s in _summed(rows, d, d, lambda x: x.sum(0))]
        self.base = np.array([s // n for s in self.sums], np.int64)
        self.rest = np.array([s % n for s in self.sums], np.int64)  # S - n * base
        base = self.base

        def centred(x):
            y = (x - base).astype(float)
            return (y.T @ y).ravel()

        self.covariance = np.asarray(_summed(rows, d, d * d, centred), float).reshape(d, d) / n
        left = self.rest / n
        self.covariance -= np.outer(left, left)
        self.values, self.vectors = leading_eigenpairs(self.covariance, k)
        trace = float(np.trace(self.covariance))
        self.explained = self.values / trace if trace > 0 else np.zeros(len(self.values))
        self.live = self.values > 1e-12 * trace if trace > 0 else np.zeros(len(self.values), bool)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projection of x - S/n over sqrt(e); rows x components, NaN where there is no variance."""
        y = (x - self.base) - self.rest / self.n
        return (y @ self.vectors.T) / np.where(self.live, np.sqrt(np.where(self.live, self.values, 1)), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        y, n = x - self.base, self.n
        if self.d * (n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 < 1 << 63:
            return ((n * y - self.rest) ** 2).sum(1).tolist()
        sums = [sum((n * int(c) - int(r)) ** 2 for c, r in zip(row, self.rest)) for row in y]
        return [s if s < 1 << 63 else None for s in sums]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = N_COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component."""
    spark: SparkSession = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, d, n = usable(df, vector_col)
    if not n:
        return spark.createDataFrame([], schema)
    fit = Fit(rows, d, n, k)
    sent = spark.sparkContext.broadcast(fit)
    live = np.flatnonzero(fit.live)

    def outer(x):
        w = sent.value.whiten(x)[:, live]
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    error = None
    if len(live):
        got = np.asarray(_summed(rows, d, len(live) * (len(live) + 1), outer), float) / n
        mean = got[len(live) ** 2 :]
        error = float(np.abs(got[: len(live) ** 2].reshape(len(live), -1) - np.outer(mean, mean) - np.eye(len(live))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = sent.value
        m = len(f.values)
        for b in batches:
            x = _vectors(b.column(1), d)
            w = f.whiten(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(np.arange(len(x)), m))),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(w), f.n)),
                    pa.array([v for v in f.deviation(x) for _ in range(m)], pa.int64()),
                    pa.array(w, pa.float64(), mask=np.isnan(w)),
                    pa.array(np.tile(f.explained, len(x))),
                    pa.array([error] * len(w), pa.float64()),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(id_col, "__v").mapInArrow(run, schema)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
