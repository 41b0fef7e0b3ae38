"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Vectors become whole numbers, so sums are exact. Mean and covariance are taken
over the different vectors: Spark sums a matrix per task, and sums those by
matrix row, so that only one matrix, as wide as the vectors, comes to the
driver. Its eigenvectors are computed in 32 bits and then corrected by
iterations of matrix products in extended precision (Ogita and Aishima, 2018):
the part of E in X(I + E) that belongs to two eigenvalues is their residual
over the distance of the two, and the error is squared by each step. Where
eigenvalues are closer together than the error allows to tell, E only makes
their vectors orthogonal, and the small problem of the cluster alone, shifted
by its middle so that the differences keep their digits, is solved to turn the
vectors inside it (Ogita and Aishima, 2019).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import fresh_names, saved

#: x = floor(STEPS c) + OFFSET; entries beyond the bound either way count as the bound.
STEPS, OFFSET, BOUND = 64, 1_000_000, 2.0**40
#: Steps of refinement at most; error and gap, relative to the matrix, at which vectors and eigenvalues count as final and equal.
MOST_STEPS, FINE = 20, 2.0**-60
#: Slices of a factor in extended precision, some 20 bits each.
SLICES = 4
#: Rows that are multiplied together.
BLOCK = 8192


# --- eigenvectors --------------------------------------------------------------------


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Numbers of neighbouring eigenvalues, in falling order, that are no further apart than ``width``."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > width) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _slices(m: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """``m`` as a sum of matrices whose entries have so few bits that products of two of them are exact in 64 bits."""
    out = []
    for _ in range(SLICES):
        most = np.abs(m).max(axis=axis, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(most > 0, most, 1))) - bits)
        part = np.rint(m / unit) * unit
        out.append(part.astype(np.float64))
        m = m - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in extended precision, as a sum of exact 64-bit products of slices (Ozaki et al., 2012)."""
    bits = (52 - int(np.ceil(np.log2(max(a.shape[1], 2))))) // 2
    left, right = _slices(a, 1, bits), _slices(b, 0, bits)
    out = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for i in reversed(range(SLICES)):  # the smallest terms first
        for j in reversed(range(SLICES - i)):
            out += left[i] @ right[j]
    return out


def _norm(m: np.ndarray) -> np.longdouble:
    """Frobenius norm, an upper bound of the spectral one."""
    return np.sqrt((m * m).sum())


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton steps to the nearest matrix with orthonormal columns."""
    for _ in range(3):
        x = x + product(x, np.eye(x.shape[1], dtype=x.dtype) - product(x.T, x)) / 2
    return x


def _solved(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Vectors of one cluster, turned to eigenvectors of the matrix between them."""
    x = _orthonormal(x)
    ax = product(a, x)
    middle = (x * ax).sum(axis=0).mean()
    small = product(x.T, ax - middle * x)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if not size > 0:
        return x
    _, turn = np.linalg.eigh((small / size).astype(np.float64))
    return _orthonormal(product(x, turn.astype(x.dtype)))


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix from approximate ``x``, in extended precision."""
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    eye, size = np.eye(len(a), dtype=np.longdouble), _norm(a)
    if not size > 0:
        return np.zeros(len(a)), np.eye(len(a))
    last = np.longdouble(np.inf)
    for _ in range(MOST_STEPS):
        r, s = eye - product(x.T, x), product(x.T, product(a, x))
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = 2 * (_norm(off) + size * _norm(r))
        if error >= last / 2 and error <= size * len(a) * 2.0**-50:
            break  # rounding is all that is left
        last = error
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= max(error, size * FINE)
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + product(x, e)
        for group in _clusters(values, float(max(error, size * FINE))):
            x[:, group] = _solved(a, x[:, group])
    x = _orthonormal(x)
    return (x * product(a, x)).sum(axis=0), x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns, to double precision."""
    scale = np.abs(a).max() if a.size else 0.0
    if not scale > 0:
        return np.zeros(len(a)), np.eye(len(a))
    _, start = np.linalg.eigh((a / scale).astype(np.float32))
    values, x = refined(a / scale, start)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


# --- sums over rows -------------------------------------------------------------------


def whole_numbers(entries: Column) -> Column:
    """The vector as longs, null where it is null, empty, or holds an entry that is null or not finite."""
    doubles = entries.cast("array<double>")
    fine = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size(doubles) > 0)
    near = lambda c: F.greatest(F.least(STEPS * c, F.lit(BOUND)), F.lit(-BOUND))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(doubles, lambda c: F.floor(near(c)).cast("bigint") + OFFSET))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> list[int]:
    """Exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            high = (x >> 20).sum(axis=0).tolist()  # halves don't overflow
            low = (x & 0xFFFFF).sum(axis=0).tolist()
            total = [t + (h << 20) + n for t, h, n in zip(total, high, low, strict=True)]
        numbers = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), numbers], ["i", "s"])

    parts = fit.select("x").mapInArrow(add, "i int, s decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("s").alias("s")).collect()  # one per dimension
    out = [0] * dim
    for r in rows:
        out[r.i] = int(r.s)
    return out


def _products(fit: DataFrame, shape: Callable[[np.ndarray], np.ndarray], dim: int, width: int) -> np.ndarray:
    """Sum of the outer products of what ``shape`` makes of the vectors.

    A task adds up one matrix, in extended precision; the matrices of all tasks
    are summed by matrix row.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), np.longdouble)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for i in range(0, len(x), BLOCK):
                y = shape(x[i : i + BLOCK])
                total += y.T @ y
        lines = pa.array(total.astype(np.float64).tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), lines], ["i", "v"])

    parts = fit.select("x").mapInArrow(multiply, "i int, v array<double>")
    summed = parts.groupBy("i").agg(*(F.sum(F.get("v", F.lit(j))).alias(f"v{j}") for j in range(width)))
    out = np.zeros((width, width))
    for r in summed.collect():  # one per matrix row
        out[r[0]] = r[1:]
    return (out + out.T) / 2


@dataclass
class Whitening:
    """What whitening needs: the exact mean as whole part and rest, and the leading components."""

    dim: int
    n: int
    whole: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the root of the eigenvalue; NaN for a component without spread."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return (self.centred(x) @ self.vectors) * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2 in whole numbers; None beyond 64 bits."""
        apart = x - self.whole
        if (float(np.abs(apart).max(initial=0)) + 1) * self.n < 2**30 / max(self.dim, 1) ** 0.5:
            d = self.n * apart - self.rest
            return (d * d).sum(axis=1).tolist()
        out = []
        for row in apart.tolist():
            value = sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest.tolist(), strict=True))
            out.append(value if value < 2**63 else None)
        return out


def fit_whitening(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """Whitening over the different vectors in column ``x``, all of one length; None without any."""
    first = vectors.select(F.size("x").alias("dim")).first()
    if first is None:
        return None
    dim = first.dim
    fit = saved(vectors.select("x").distinct(), "whitening-fit")
    n, sums = fit.count(), _sums(fit, dim)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    model = Whitening(dim, n, whole, rest, np.zeros((dim, 0)), np.zeros(0), np.zeros(0))

    covariance = _products(fit, model.centred, dim, dim) / n
    values, found = eigen(covariance)
    k = min(components, dim)
    floor = values[0] * dim * 2.0**-52  # below it an eigenvalue is rounding
    model.vectors, model.values = found[:, :k], np.where(values[:k] > floor, values[:k], 0.0)
    trace = np.trace(covariance)
    model.explained = model.values / trace if trace > 0 else np.zeros(k)
    spread = int((model.values > 0).sum())
    if spread:  # the mean of whitened vectors is 0
        unit = _products(fit, lambda x: model.whitened(x)[:, :spread], dim, spread) / n
        model.identity_error = float(np.abs(unit - np.eye(spread)).max())
    return model


def whiten(df: DataFrame, components: int = 16, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, empty, or holds a null or non-finite entry are
    left out; so are vectors of another length than most (of two lengths
    equally frequent, the greater one counts). Repeated rows and ids each give
    rows, and equal vectors count once in the fit; a null id stays null. With
    fewer dimensions than ``components`` there are as many rows as dimensions.
    A component without spread has explained 0 and null ``whitened``; with no
    spread at all ``identity_error`` is null as well. ``deviation`` is null
    where it doesn't fit 64 bits. Equal eigenvalues come in an order that is
    the same for all rows. An empty table gives no rows. Other columns are left
    out.
    """
    rows = df.select(F.col(vec_id).alias("vec_id"), whole_numbers(F.col(embedding)).alias("x")).where("x is not null")
    rows = saved(rows, "whole-vectors")
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if lengths is not None:
        rows = rows.where(F.size("x") == lengths.dim)
    model = fit_whitening(rows, components)
    kind = "array<struct<component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>>"
    (name,) = fresh_names(rows, "found")

    @F.arrow_udf(kind)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _matrix(batch, model.dim)
            k, y = len(model.values), model.whitened(x)
            per_row = lambda values, type_: pa.array(np.repeat(np.array(values, object), k), type_)
            columns = {
                "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(x) * k, model.n), pa.int64()),
                "deviation": per_row(model.deviations(x), pa.int64()),
                "whitened": pa.array(y.ravel(), pa.float64(), from_pandas=True),
                "explained": pa.array(np.tile(model.explained, len(x)), pa.float64()),
                "identity_error": pa.array([model.identity_error] * (len(x) * k), pa.float64()),
            }
            cells = pa.StructArray.from_arrays(list(columns.values()), list(columns))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), cells)

    if model is None:
        return rows.select("vec_id", F.explode(F.lit(None).cast(kind)).alias(name)).select("vec_id", f"{name}.*")
    return rows.select("vec_id", F.explode(found("x")).alias(name)).select("vec_id", f"{name}.*")
