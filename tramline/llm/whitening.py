"""Whitening of embeddings by a distributed, shifted CholeskyQR.

A vector's entries c become the lattice point x = floor(64 c) + 1000000. The
fit list holds each distinct point once, written to the shared folder. Passes
over it, each one Gram matrix summed by Spark:

1. counts and sums, in whole numbers;
2. G = A'A of the centred rows A, a shifted Cholesky factor R1 of it;
3. G of Q = A inv(R1), where each task solves its rows against the triangle,
   and a factor R2, and so on until Q's columns are orthonormal (two or three
   passes; a shift is added where a factor would break down);
4. the covariance of the whitened fit list, for its distance to the identity.

The product R of the factors has the centred rows' singular values and right
vectors, so a small SVD on the driver gives all components to double
precision: the condition number is not squared as it is in a covariance.

To the driver come d sums and d x d matrices (d: the vectors' length), never
rows. A task holds one Arrow batch and a d x d matrix.

Defined cases: a vector that is null or holds null or non-finite entries is
dropped; so is an empty one, and one whose length is not the table's most
frequent (of equally frequent ones the larger). Entries beyond 2**34 in size are held
there, so that points stay whole numbers that can be summed. Directions
without variance (a spread below 1e-10 of the widest) give no components, so a fit list of one point gives no rows.
Repeated rows and null ids are rows like others; other columns are ignored. A
deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import settle, with_python

SCALE, OFFSET = 64, 1_000_000
#: Entries are held at this size: 64 times it, and sums of such points, stay 64-bit.
LARGEST = float(1 << 34)
COMPONENTS = 16
#: Columns of Q count as orthonormal from here on; singular values below NO_SPREAD of the largest are none.
ORTHONORMAL, NO_SPREAD, MOST_PASSES = 1e-11, 1e-10, 8


def lattice_point(vector: Column) -> Column:
    """x of every entry, as an array of longs; the vector must be finite."""
    return F.transform(vector, lambda c: F.floor(
        F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE).cast("long") + OFFSET)


def finite_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.filter(v.isNotNull() & (F.size(v) > 0) & ~bad)


def _points(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


def _deviations(x: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """n x - S, exact: in 64 bits where they hold it, else as Python integers."""
    wide = n * (int(np.abs(x).max(initial=0)) + int(OFFSET + LARGEST * SCALE)) >= 1 << 62
    return n * x.astype(object) - total.astype(object) if wide else n * x - total


def _centred(x: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    return _deviations(x, total, n).astype(np.float64) / n


def _solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a inv(r) for an upper triangle r, column by column."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d + 1, np.int64)
        for batch in batches:
            total[:d] += _points(batch.column(0), d).sum(axis=0)
            total[d] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1), pa.int32()), pa.array(total)], names=["j", "s"])

    out = np.zeros(d + 1, np.int64)
    for r in fit.select("x").mapInArrow(work, "j int, s long").groupBy("j").agg(F.sum("s").alias("s")).collect():
        out[r.j] = r.s
    return int(out[d]), out[:d]


def _gram(fit: DataFrame, d: int, view: Callable[[np.ndarray], np.ndarray], k: int) -> np.ndarray:
    """The Gram matrix of ``view`` (rows of k numbers) of all points, summed over tasks."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                q = view(_points(batch.column(0), d))
                g += q.T @ q
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i * k + j, pa.int32()), pa.array(g[i, j])], names=["ij", "g"])

    g = np.zeros(k * k)
    for r in fit.select("x").mapInArrow(work, "ij int, g double").groupBy("ij").agg(F.sum("g").alias("g")).collect():
        g[r.ij] = r.g
    g = g.reshape(k, k)
    return g + np.triu(g, 1).T


def _factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor; with a shift on request, or where there is none without."""
    d = len(g)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * max(float(np.linalg.eigvalsh(g)[-1]), np.finfo(float).tiny)
    at = shift if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + at * np.eye(d)).T
        except np.linalg.LinAlgError:
            at = max(2 * at, shift)


def shifted_cholesky_qr(fit: DataFrame, d: int, n: int, total: np.ndarray) -> tuple[np.ndarray, float]:
    """R with R'R = A'A for the centred rows A of ``fit``, and the trace of A'A."""
    factors: list[np.ndarray] = []
    trace = 0.0
    for _ in range(MOST_PASSES):
        held = list(factors)

        def view(x: np.ndarray, held: list[np.ndarray] = held) -> np.ndarray:
            q = _centred(x, total, n)
            for r in held:
                q = _solve(q, r)
            return q

        g = _gram(fit, d, view, d)
        trace = trace or float(np.trace(g))
        if trace == 0.0:
            return np.zeros((d, d)), 0.0
        if factors:
            w = np.linalg.eigvalsh(g)
            if np.all((np.abs(w - 1) < ORTHONORMAL) | (np.abs(w) < ORTHONORMAL)):
                break
        factors.append(_factor(g, n, not factors))
    else:
        factors.pop()  # g was measured before this one
    w, u = np.linalg.eigh(g)
    r = (u * np.sqrt(np.maximum(w, 0))) @ u.T  # the identity but for rounding and directions without variance
    for f in reversed(factors):
        r = r @ f
    return r, trace


def components(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(V, e): unit eigenvectors of R'R / n as columns, with falling eigenvalues."""
    _, s, vt = np.linalg.svd(r)
    keep = (s > NO_SPREAD * s[0])[:most] if s[0] > 0 else np.zeros(0, np.bool_)
    m = int(keep.sum())
    return vt[:m].T, s[:m] ** 2 / n


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every valid row."""
    with_python(rows.sparkSession)
    valid = finite_vectors(rows.select(F.col(key).alias("key"), F.col(vector).alias("v")), "v")
    lengths = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0].d if lengths else 1
    points = valid.filter(F.size("v") == d).select("key", lattice_point(F.col("v")).alias("x"))
    fit = settle(points.select("x").distinct(), "whitening-fit")
    n, total = _sums(fit, d)
    r, trace = shifted_cholesky_qr(fit, d, n, total) if n else (np.zeros((d, d)), 0.0)
    vectors, e = components(r, n, most) if trace else (np.zeros((d, 0)), np.zeros(0))
    m = len(e)
    onto = vectors / np.sqrt(e)
    error = float(np.abs(_gram(fit, d, lambda x: _centred(x, total, n) @ onto, m) / n - np.eye(m)).max()) if m else 0.0
    explained = e * n / trace if m else e
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_rows
            if not k or not m:
                continue
            dev = _deviations(_points(batch.column(1), d), total, n)
            white = (dev.astype(np.float64) / n) @ onto
            if np.abs(dev).max() >= int((1 << 62) / d) ** 0.5:
                dev = dev.astype(object)
            square = [s if s < 1 << 63 else None for s in (dev * dev).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(k), m))), pa.array(np.tile(np.arange(1, m + 1), k), pa.int32()),
                 pa.array(np.full(k * m, n)), pa.array(square, pa.int64()).take(pa.array(np.repeat(np.arange(k), m))),
                 pa.array(white.ravel()), pa.array(np.tile(explained, k)), pa.array(np.full(k * m, error))], names=names)

    key_type = rows.schema[key].dataType.simpleString()
    return points.mapInArrow(work, f"`{key}` {key_type}, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")
