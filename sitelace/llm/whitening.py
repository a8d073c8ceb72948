"""Whitening of embeddings: their leading principal components by LOBPCG, with covariance products made by Spark.

Vectors are taken in fixed point, x = floor(scale * c) + shift as integers, so their sums are exact.  Rows whose vector is
null, or holds a null or an entry that is not finite, are out; so are vectors that are empty or of another length than most
(of equally common lengths the longest).  All others are fitted, repeated rows as often as they occur.

Method: the covariance V is never formed.  One pass of Spark over the rows gives V B for a block of vectors B: each task
centres its rows (n x - S is exact before it is divided by n), multiplies them with B and back, and the partial sums are
added up cell by cell with partial aggregation; what reaches the driver has the size of the block.  Rayleigh-Ritz takes the
best vectors from the span of the iterate, its residuals and the previous directions, until the residuals of the wanted
vectors, from a product made anew, are below TOLERANCE of the largest eigenvalue.  If rounding stops them above it, they
must be below ACCEPTED, or the fit fails loudly.

A component whose eigenvalue is below RANK of the largest is not told from rounding and left out, so constant or empty
input has none.  Equal eigenvalues leave their vectors free within their space; the seed settles which are taken.  Entries
beyond 2**40 after scaling count as that; a squared deviation that does not fit in 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, one_blas_thread, worker_cache

TOLERANCE, ACCEPTED, RANK = 1e-14, 1e-10, 1e-11
#: Vectors of the block beyond those wanted, rounds at most, and rounds without progress after which rounding is to blame.
GUARD, ROUNDS, STALLED = 8, 500, 8
FARTHEST = float(1 << 40)


@dataclass(frozen=True)
class FixedPoint:
    """x = floor(scale * c) + shift."""

    scale: float = 64.0
    shift: int = 1_000_000

    def vectors(self, column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(which rows are in, their x-vectors) of an Arrow list column."""
        held = pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False)
        entries = column.filter(pa.array(held)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null is nan
        rows = entries.reshape(-1, size)
        finite = np.isfinite(rows).all(axis=1)
        inside = held.copy()
        inside[held] = finite
        scaled = np.clip(np.floor(rows[finite] * self.scale), -FARTHEST, FARTHEST)
        return inside, scaled.astype(np.int64) + self.shift


@dataclass(frozen=True)
class Whitening:
    """What a fit found: n rows, exact sums by dimension, components as columns by falling eigenvalue, eigenvalues, trace of
    V, residual norms over the largest eigenvalue, the largest entry of the whitened covariance minus the identity."""

    fixed: FixedPoint
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float
    passes: int

    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S as integers."""
    whole, rest = np.divmod(sums, n)
    return n * (x - whole) - rest


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(False))


def _totals(df: DataFrame, fixed: FixedPoint) -> tuple[int, np.ndarray]:
    """(n, S), both exact."""
    (name,) = df.columns
    sizes = df.where(_usable(F.col(name))).groupBy(F.size(name).alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.col("n").desc(), F.col("size").desc()).limit(1).collect()
    if not common:
        return 0, np.zeros(0, np.int64)
    n, size = common[0]["n"], common[0]["size"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("whitening")
        one_blas_thread()
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += fixed.vectors(batch.column(0), size)[1].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["cell", "value"])

    rows = df.mapInArrow(sums, "cell bigint, value bigint").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["cell"]] = r["value"]
    return n, out


def _summed(df: DataFrame, fixed: FixedPoint, n: int, sums: np.ndarray, shape: tuple[int, ...], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all centred rows of `part`, an array of `shape` for each block of rows, divided by n."""
    size, cells = len(sums), int(np.prod(shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("whitening")
        one_blas_thread()
        total = np.zeros(cells)
        for batch in batches:
            x = fixed.vectors(batch.column(0), size)[1]
            if len(x):
                total += part(centred(x, n, sums) / n).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], ["cell", "value"])

    rows = df.mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(cells)
    for r in rows:
        out[r["cell"]] = r["value"]
    return out.reshape(shape) / n


def _orthonormal(x: np.ndarray, ax: np.ndarray, d: np.ndarray, ad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An orthonormal basis of what `d` adds to the orthonormal `x`, and its products, by the same linear steps."""
    for _ in range(2):
        along = x.T @ d
        d, ad = d - x @ along, ad - ax @ along
        length = np.linalg.norm(d, axis=0)
        keep = length > 1e-10
        d, ad = d[:, keep] / length[keep], ad[:, keep] / length[keep]
        if not d.shape[1]:
            break
        _, s, turn = np.linalg.svd(d, full_matrices=False)
        keep = s > 1e-7 * s[0]
        turn = turn[keep].T / s[keep]
        d, ad = d @ turn, ad @ turn
    return d, ad


def lobpcg(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, vectors as columns, residual norms over the largest eigenvalue) of a symmetric operator that is given
    by its products with blocks.  Residuals returned are from a product made anew."""
    block = min(size, wanted + GUARD)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
    ax = product(x)
    p = ap = np.zeros((size, 0))
    best, stalled = np.inf, 0
    for _ in range(ROUNDS):
        inner = x.T @ ax
        e, turn = np.linalg.eigh((inner + inner.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        x, ax = x @ turn, ax @ turn
        top = max(e[0], np.finfo(float).tiny)
        r = ax - x * e
        off = np.linalg.norm(r, axis=0) / top
        worst = off[:wanted].max()
        stalled = 0 if worst < best / 2 else stalled + 1
        best = min(best, worst)
        if worst <= TOLERANCE or stalled >= STALLED or e[0] <= 0:
            # A certificate needs vectors that are orthonormal, and products that no linear step has touched.
            x = np.linalg.qr(x)[0]
            ax = product(x)
            inner = x.T @ ax
            e, turn = np.linalg.eigh((inner + inner.T) / 2)
            e, turn = e[::-1], turn[:, ::-1]
            x, ax = x @ turn, ax @ turn
            off = np.linalg.norm(ax - x * e, axis=0) / max(e[0], np.finfo(float).tiny)
            if off[:wanted].max() <= (TOLERANCE if not stalled >= STALLED else ACCEPTED) or e[0] <= 0:
                return e[:wanted], x[:, :wanted], off[:wanted]
            if stalled >= 3 * STALLED:
                break
            continue
        active = off > TOLERANCE / 4
        r = r[:, active] / np.maximum(np.linalg.norm(r[:, active], axis=0), np.finfo(float).tiny)
        r -= x @ (x.T @ r)
        r = np.linalg.qr(r)[0]
        d, ad = _orthonormal(x, ax, np.hstack([r, p]), np.hstack([product(r), ap]))
        basis, images = np.hstack([x, d]), np.hstack([ax, ad])
        inner = basis.T @ images
        _, turn = np.linalg.eigh((inner + inner.T) / 2)
        turn = turn[:, ::-1][:, :block]
        k = x.shape[1]
        x, ax, p, ap = basis @ turn, images @ turn, d @ turn[k:], ad @ turn[k:]
    raise ArithmeticError(f"no certified components: residuals are {best} of the largest eigenvalue")


def fit(df: DataFrame, vector: str, components: int = 32, fixed: FixedPoint = FixedPoint(), seed: int = 0) -> Whitening | None:
    """The leading components of all usable vectors; None if there are no rows or no component."""
    rows = df.select(F.col(vector).alias("v"))
    n, sums = _totals(rows, fixed)
    if n == 0:
        return None
    size, passes = len(sums), 0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _summed(rows, fixed, n, sums, block.shape, lambda x: x.T @ (x @ block))

    trace = float(_summed(rows, fixed, n, sums, (1,), lambda x: np.array([(x * x).sum()]))[0])
    if trace == 0:
        return None
    e, u, residuals = lobpcg(product, size, min(components, size), seed)
    told = e > RANK * e[0]
    e, u, residuals = e[told], u[:, told], residuals[told]
    u = u / np.linalg.norm(u, axis=0)
    scaled = u / np.sqrt(e)
    covariance = _summed(rows, fixed, n, sums, (len(e), len(e)), lambda x: (z := x @ scaled).T @ z)
    return Whitening(fixed, n, sums, u, e, trace, residuals, float(np.abs(covariance - np.eye(len(e))).max()), passes)


def whiten(df: DataFrame, vector: str, model: Whitening) -> DataFrame:
    """The usable rows with `whitened`, an entry for each component, and `deviation`, the sum over dimensions of
    (n x - S)^2.  Other columns stay; new ones whose names are taken get underscores."""
    fixed, n, sums, scaled = model.fixed, model.n, model.sums, model.components / np.sqrt(model.eigenvalues)
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_cache("whitening")
        one_blas_thread()
        for column in batches:
            inside, x = fixed.vectors(column, len(sums))
            off = centred(x, n, sums)
            rough = (off.astype(float) ** 2).sum(axis=1)
            exact = pa.array((off * off).sum(axis=1), mask=rough > 9.2e18)
            z = (off / n) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            places = np.cumsum(inside) - 1
            made = pa.StructArray.from_arrays([exact, lists], fields=list(kind))
            yield made.take(pa.array(places, mask=~inside))

    cell = fresh("whitening_cell", *df.columns)
    out = df.withColumn(cell, F.arrow_udf(run, "struct<deviation:bigint,whitened:array<double>>")(F.col(vector))).where(F.col(cell).isNotNull())
    for part in ("deviation", "whitened"):
        out = out.withColumn(fresh(part, *df.columns), F.col(cell)[part])
    return out.drop(cell)
