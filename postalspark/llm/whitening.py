"""Embedding whitening: eigenvectors of a covariance that is never formed, by a block Jacobi-Davidson method.

The covariance V of the fit list enters only through distributed products V B with a block B of a few vectors: each
task adds up y (y B) over its rows' centred vectors y = (n x - S) / n, whose numerator is an exact integer, and the
tasks' d x m sums are added by a Spark aggregate. Around it, on the driver and of the size of the embedding's
dimension only: Rayleigh-Ritz in the search space, locking of leading pairs whose residual is down to double
precision, and for all pairs still open the correction equations
(I - QQ')(V - theta I)(I - QQ') t = -r (Q: locked vectors and the pair's own), solved by a few steps of MINRES, all pairs in step,
so that one job serves them all. The search space is restarted from its leading Ritz vectors when it gets wide.

Defined cases: rows whose vector is null, empty or holds a null, NaN or infinite entry are dropped; shorter vectors are
padded by zero entries (x = offset); null and repeated ids are kept, row by row; components whose variance is
zero to double precision are left out (all rows equal, a single row and an empty table give no rows);
``deviation`` is null where it does not fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import Vectors, integers, matrix

#: steps of MINRES per correction equation, and bound of the outer loop
INNER, OUTER = 6, 200
_EPS = float(np.finfo(np.float64).eps)


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int, width: int, kind: str = "double") -> np.ndarray:
    """``part`` of each batch of vectors, summed over the table: ``size`` numbers come back."""
    dtype = np.float64 if kind == "double" else np.int64

    def run(batches):
        total = np.zeros(size, dtype)
        for batch in batches:
            if batch.num_rows:
                total += part(matrix(batch.column(0), width)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "v"])

    out = np.zeros(size, dtype)
    for r in rows.select("x").mapInArrow(run, f"k long, v {kind}").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


@dataclass(frozen=True)
class Moments:
    """Size and exact sums of the fit list; ``centred`` gives its rows minus the mean."""

    n: int
    sums: np.ndarray

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        return self.n * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x) / self.n


class Covariance:
    """The covariance of the fit list as an operator on d x m blocks; one Spark job a product."""

    def __init__(self, v: Vectors):
        self.v, self.products = v, 0
        sums = _added(v.rows, lambda x: x.sum(axis=0), v.width, v.width, "long") if v.n else np.zeros(0, np.int64)
        self.moments = Moments(v.n, sums)

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        at = self.moments

        def part(x: np.ndarray) -> np.ndarray:
            y = at.centred(x)
            return y.T @ (y @ block)

        self.products += 1
        return _added(self.v.rows, part, block.size, self.v.width).reshape(block.shape) / at.n

    def trace(self) -> float:
        at = self.moments
        return float(_added(self.v.rows, lambda x: (at.centred(x) ** 2).sum(keepdims=True), 1, self.v.width)[0]) / at.n


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal vectors for what ``new`` adds to ``bases`` (two passes; directions lost to rounding are dropped)."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), np.finfo(np.float64).tiny)
    out = np.zeros((len(new), 0))
    for column in new.T:
        t = column
        for _ in range(2):
            for basis in (*bases, out):
                t = t - basis @ (basis.T @ t)
            size = np.linalg.norm(t)
            if size < 1e-10:
                break
            t = t / size
        else:
            out = np.column_stack([out, t])
    return out


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` of MINRES from zero for each column of ``right``, in step; ``product`` applies each column's own symmetric operator."""
    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=np.abs(b) > tiny)

    tiny = np.finfo(np.float64).tiny * 1e10
    x, before, w_before, w = (np.zeros_like(right) for _ in range(4))
    now, gamma = right, np.linalg.norm(right, axis=0)
    start, rest = gamma, gamma
    c_before = c = np.ones_like(gamma)
    s_before = s = np.zeros_like(gamma)
    for _ in range(steps):
        live = gamma > _EPS * start
        unit = over(now, gamma) * live
        image = product(unit)
        delta = (unit * image).sum(axis=0)
        ahead = image - delta * unit - gamma * before
        gamma_ahead = np.linalg.norm(ahead, axis=0)
        a0 = c * delta - c_before * s * gamma
        a1 = np.hypot(a0, gamma_ahead)
        a2, a3 = s * delta + c_before * c * gamma, s_before * gamma
        c_before, s_before, c, s = c, s, over(a0, a1), over(gamma_ahead, a1)
        w_before, w = w, over(unit - a3 * w_before - a2 * w, a1)
        x = x + live * (c * rest) * w
        rest = -s * rest
        before, now, gamma = unit, ahead, gamma_ahead
    return x


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues (falling), unit eigenvectors in columns, and the largest residual norm."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, inner: int = INNER, outer: int = OUTER,
                    seed: int = 7) -> Spectrum:
    """The ``k`` largest eigenpairs (all ``d``, if fewer) of a symmetric positive semidefinite operator on d x m blocks.

    A pair is locked once its residual norm is at most 4 d eps times the largest eigenvalue, leading pairs first.
    Raises if that isn't reached within ``outer`` rounds.
    """
    k = min(k, d)
    widest = min(d, max(4 * k, 2 * k + 8))
    locked, values = np.zeros((d, 0)), np.zeros(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, k + 8))))
    images = product(space)
    for _ in range(outer):
        small = space.T @ images
        theta, ritz = np.linalg.eigh((small + small.T) / 2)
        theta, ritz = theta[::-1], ritz[:, ::-1]
        space, images = space @ ritz, images @ ritz
        scale = max(theta.max(initial=0.0), values.max(initial=0.0), np.finfo(np.float64).tiny)
        wanted = min(k - len(values), len(theta))
        left = images[:, :wanted] - space[:, :wanted] * theta[:wanted]
        left = left - locked @ (locked.T @ left)
        size = np.linalg.norm(left, axis=0)
        full = locked.shape[1] + space.shape[1] >= d      # Rayleigh-Ritz in the whole space leaves rounding only
        good = np.ones(wanted, bool) if full else size <= 4 * d * _EPS * scale
        new = wanted if good.all() else int(good.argmin())
        if new:
            values = np.concatenate([values, theta[:new]])
            locked = np.column_stack([locked, space[:, :new]])
            space, images, theta, left = space[:, new:], images[:, new:], theta[new:], left[:, new:]
        if len(values) >= k:
            break
        if space.shape[1] + left.shape[1] > widest:
            keep = min(space.shape[1], left.shape[1] + 8)
            space, images = space[:, :keep], images[:, :keep]
        own, shift = space[:, :left.shape[1]], theta[:left.shape[1]]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - own * (own * t).sum(axis=0)

        def corrected(t: np.ndarray) -> np.ndarray:
            t = projected(t)
            return projected(product(t) - t * shift)

        step = projected(minres(corrected, -projected(left), inner)) if left.size else np.zeros((d, 0))
        more = _orthonormal(step, locked, space)
        if not more.shape[1]:       # nothing new: fresh directions
            more = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((d, max(1, left.shape[1]))), locked, space)
        # images lose their part along locked vectors, which Rayleigh-Ritz mustn't see again
        space, images = np.column_stack([space, more]), np.column_stack([images, product(more)])
    else:
        raise ArithmeticError(f"{len(values)} of {k} pairs after {outer} rounds")
    image = product(locked)
    theta = (locked * image).sum(axis=0)
    order = np.argsort(-theta, kind="stable")
    return Spectrum(theta[order], locked[:, order], float(np.linalg.norm(image - locked * theta, axis=0).max(initial=0.0)))


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: moments, eigenpairs of positive variance, their shares of the trace, and the identity error."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    residual: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(v: Vectors, k: int) -> Whitening:
    """Moments, leading components and the measured covariance of the whitened fit list."""
    cov = Covariance(v)
    trace = cov.trace() if v.n and v.width else 0.0
    if trace <= 0.0:
        return Whitening(cov.moments, np.zeros(0), np.zeros((v.width, 0)), np.zeros(0), 0.0, 0.0)
    s = jacobi_davidson(cov.__matmul__, v.width, k)
    kept = s.values > 16 * v.width * _EPS * s.values.max()
    w = Whitening(cov.moments, s.values[kept], s.vectors[:, kept], s.values[kept] / trace, 0.0, s.residual)
    m = len(w.values)
    mean = _added(v.rows, lambda x: w.whitened(x).sum(axis=0), m, v.width) / v.n

    def products(x: np.ndarray) -> np.ndarray:
        z = w.whitened(x) - mean
        return z.T @ z

    identity = _added(v.rows, products, m * m, v.width).reshape(m, m) / v.n
    return Whitening(w.moments, w.values, w.vectors, w.explained, float(np.abs(identity - np.eye(m)).max()), w.residual)


def whiten(df: DataFrame, k: int = 32, scale: int = 64, offset: int = 1_000_000, vector: str = "embedding") -> DataFrame:
    """Whitened coordinates on the ``k`` leading components of x = floor(scale * c) + offset.

    Returns vec_id, component (int, from 1), n, deviation (sum over dimensions of (n x - S)^2, exact), whitened, explained, identity_error:
    a row per remaining row and component.
    """
    some = df.where(F.size(vector) > 0)
    v = integers(some, lambda c: F.floor(c * scale) + offset, {"vec_id": F.col("vec_id").cast("long")}, vector)
    rows, width = v.rows, v.width
    if v.largest >= 1 << 62 or v.n * 2 * v.largest >= 1 << 63:
        raise ValueError(f"sums of {v.n} components up to {v.largest} do not fit a long")
    if v.n:
        # absent entries of shorter vectors are zeros, whose x is the offset
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size("x"))))
    w = fit(Vectors(rows, v.n, width, v.largest), k)
    m = len(w.values)

    def run(batches):
        for batch in batches:
            # a slice of rows at a time: each becomes m rows
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = matrix(part.column("x"), width)
                num = w.moments.numerators(x)
                if int(np.abs(num).max(initial=0)) ** 2 * width < 1 << 63:
                    deviation = pa.array((num ** 2).sum(axis=1), pa.int64())
                else:
                    exact = [sum(int(c) ** 2 for c in row) for row in num]
                    deviation = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
                rows_out = np.repeat(np.arange(len(x)), m)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows_out)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(rows_out), w.moments.n)), deviation.take(pa.array(rows_out)), pa.array(w.whitened(x).ravel()),
                     pa.array(np.tile(w.explained, len(x))), pa.array(np.full(len(rows_out), w.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
