"""Whitening of embeddings by their leading principal components.

An entry ``c`` becomes the whole number ``floor(64 * c) + 1000000`` (at most 2^40
away from 1000000; entries beyond are set to that).  Rows whose vector is null or
holds a null or an entry that is not finite are left out.  The *fit list* is each
distinct vector of whole numbers once, so copies carry no weight, however many.

Spark sums columns and products of the fit list: a task adds up its rows, minus a
whole number near the mean, and returns one matrix.  These are sums of whole
numbers, so they are exact and do not depend on partitions.  What reaches the
driver is one matrix of d x d, whatever the number of rows.  There, Householder
reflections make it tridiagonal, Sturm counts bisect the leading eigenvalues, and
inverse iteration finds their vectors, made orthogonal within clusters of close
eigenvalues.  The projection (d x components) goes to the tasks as a small value.

Defined results: vectors of another length than the commonest one (ties: the
longest) are not fitted, and their rows have null values; components of an
eigenvalue that is 0 within rounding (fewer distinct vectors than components)
have null ``whitened``; ``explained`` is null where all vectors are equal; a
``deviation`` that no long can hold is null.  Repeated rows, null keys and extra
columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quizlake.llm.common import spread
from quizlake.sources.storage import settle

COMPONENTS = 16
STEPS, SHIFT, FURTHEST = 64.0, 1_000_000, 2.0**40
EPS = float(np.finfo(float).eps)
#: Eigenvalues closer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3


# -- the symmetric eigenproblem of one small matrix --------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that made them."""
    a, mirrors = matrix.copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        size = np.linalg.norm(v)
        if size:
            v /= size
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            edge = a[k + 1 :, k]
            edge -= 2 * v * (v @ edge)
            a[k, k + 1 :] = edge
        mirrors.append(v)
    return a.diagonal().copy(), a.diagonal(1).copy(), mirrors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: negative pivots of T - x."""
    tiny = max(EPS * EPS * float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(np.int64)
    for d, b in zip(diagonal[1:], off * off, strict=True):
        pivot = d - at - b / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The largest ``k`` eigenvalues, falling, by bisection of Sturm counts."""
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low = np.full(k, float((diagonal - reach).min()))
    high = np.full(k, float((diagonal + reach).max()))
    low, high = low - EPS * np.abs(low), high + EPS * np.abs(high)
    wanted = len(diagonal) - np.arange(k)
    for _ in range(2000):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= EPS * np.maximum(np.abs(low), np.abs(high)))):
            break
        above = counts_below(diagonal, off, middle) >= wanted
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solves (T - shift) x = right by elimination with row exchange."""
    n = len(diagonal)
    first, second, third = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    x = right.tolist()
    for i in range(n - 1):
        lower = float(off[i])
        if abs(first[i]) < abs(lower):
            up = (lower, first[i + 1], second[i + 1])
            down = (first[i], second[i], third[i])
            x[i], x[i + 1] = x[i + 1], x[i]
        else:
            up = (first[i], second[i], third[i])
            down = (lower, first[i + 1], second[i + 1])
        pivot = up[0] if abs(up[0]) > tiny else tiny
        share = down[0] / pivot
        first[i], second[i], third[i] = pivot, up[1], up[2]
        first[i + 1], second[i + 1] = down[1] - share * up[1], down[2] - share * up[2]
        x[i + 1] -= share * x[i]
    if abs(first[-1]) <= tiny:
        first[-1] = tiny
    for i in range(n - 1, -1, -1):
        after = second[i] * x[i + 1] if i + 1 < n else 0.0
        after += third[i] * x[i + 2] if i + 2 < n else 0.0
        x[i] = (x[i] - after) / first[i]
        if abs(x[i]) > 1e280:
            x[i:] = [y * 1e-200 for y in x[i:]]
            x[:i] = [y * 1e-200 for y in x[:i]]
    return np.array(x)


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column for each value."""
    n, draw = len(diagonal), np.random.default_rng(7)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)) or 1.0
    tiny, found, begin, before = EPS * norm, np.zeros((n, len(values))), 0, None
    for j, value in enumerate(values.tolist()):
        shift = value
        if j and values[j - 1] - value > CLUSTER * norm:
            begin = j
        elif j and before - shift < 10 * EPS * norm:
            shift = before - 10 * EPS * norm
        before = shift
        x = draw.standard_normal(n)
        for _ in range(6):
            x = solved(diagonal, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                for i in range(begin, j):
                    x -= (found[:, i] @ x) * found[:, i]
            if np.linalg.norm(x) < 1e-8:
                x = draw.standard_normal(n)
        found[:, j] = x / np.linalg.norm(x)
    return found


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``k`` eigenvalues of a symmetric matrix, falling, and their unit
    vectors as columns; the largest entry of a vector is positive."""
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    vectors = leading_vectors(diagonal, off, values)
    for step in range(len(mirrors) - 1, -1, -1):
        v = mirrors[step][:, None]
        part = vectors[step + 1 :]
        part -= 2 * v * (v.T @ part)
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values, vectors


# -- sums over the fit list ---------------------------------------------------------------


def usable(vector: Column) -> Column:
    number = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return vector.isNotNull() & F.forall(vector, number)


def whole(vector: Column) -> Column:
    near = lambda c: F.greatest(F.lit(-FURTHEST), F.least(F.lit(FURTHEST), STEPS * c.cast("double")))
    return F.transform(vector, lambda c: F.floor(near(c)) + SHIFT)


def matrices(batches: Iterator[pa.RecordBatch], width: int, name: str = "x") -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact(value: int) -> Decimal:
    return Decimal(int(value))


def added(fit: DataFrame, width: int, summed: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[tuple[int, int], object]:
    """Adds up ``summed`` of the rows of all tasks: a matrix of whole numbers
    (``decimal(38,0)``) or doubles, as a map from its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in matrices(batches, width):
            part = summed(x)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            whole_numbers = kind.startswith("decimal")
            s = [exact(v) for v in total.ravel()] if whole_numbers else total.ravel()
            s = pa.array(s, pa.decimal128(38, 0) if whole_numbers else pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), s], ["i", "j", "s"])

    parts = fit.mapInArrow(run, f"i int, j int, s {kind}")
    return {(r["i"], r["j"]): r["s"] for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def column_sums(x: np.ndarray) -> np.ndarray:
    return np.array([[len(x), *map(int, x.sum(axis=0))]], dtype=object)


def products(y: np.ndarray) -> np.ndarray:
    """y.T y of whole numbers, exact: in doubles while every sum fits them."""
    if float(np.abs(y).max()) ** 2 * len(y) < 2.0**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


@dataclass
class Whitening:
    """What the tasks need: ``near`` is a whole number near each mean, ``rest``
    the sum of what is left (S - n * near), ``project`` the scaled components."""

    n: int
    near: np.ndarray
    rest: list[int]
    values: np.ndarray
    trace: float
    project: np.ndarray
    valid: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rest])
        return ((x - self.near).astype(np.float64) - mean) @ self.project

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2."""
        y = x - self.near
        f = self.n * y.astype(np.float64) - np.array(self.rest, dtype=np.float64)
        about, out = (f * f).sum(axis=1), []
        small = about < 2.0**61
        if small.any():
            z = self.n * y[small] - np.array(self.rest, dtype=np.int64)
            quick = iter((z * z).sum(axis=1).tolist())
        for i, ok in enumerate(small.tolist()):
            if ok:
                out.append(next(quick))
            else:
                d = sum((self.n * int(v) - r) ** 2 for v, r in zip(y[i].tolist(), self.rest, strict=True))
                out.append(d if d < 2**63 else None)
        return out


def fitted(fit: DataFrame, width: int, components: int) -> Whitening:
    sums = added(fit, width, column_sums, "decimal(38,0)")
    n = int(sums[0, 0])
    total = [int(sums[0, i + 1]) for i in range(width)]
    near = np.array([s // n for s in total], dtype=np.int64)
    rest = [s - n * m for s, m in zip(total, near.tolist(), strict=True)]
    both = added(fit, width, lambda x: products(x - near), "decimal(38,0)")
    scaled = lambda i, j: n * int(both[i, j]) - rest[i] * rest[j]
    covariance = np.array([[scaled(i, j) / n**2 for j in range(width)] for i in range(width)])
    trace = sum(scaled(i, i) for i in range(width)) / n**2
    values, vectors = leading(covariance, min(components, width))
    valid = values > width * EPS * max(float(values[0]), 0.0)
    root = np.sqrt(np.where(valid, values, 1.0))
    return Whitening(n, near, rest, values, trace, vectors / root, valid)


def identity_error(fit: DataFrame, width: int, model: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus identity."""
    if not model.valid.any():
        return None
    k = len(model.valid)

    def outer(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return w.T @ w

    found = added(fit, width, outer, "double")
    error = np.array([[found[i, j] / model.n for j in range(k)] for i in range(k)]) - np.eye(k)
    return float(np.abs(error[np.ix_(model.valid, model.valid)]).max())


# -- the operator ------------------------------------------------------------------------------

RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """(``key``, component, n, deviation, whitened, explained, identity_error), a
    row for each usable row and component."""
    spark, kind = rows.sparkSession, rows.schema[key].dataType.simpleString()
    own = spread(rows.select(F.col(key).alias("k"), F.col(vector).alias("v"))).filter(usable(F.col("v")))
    own = own.select("k", whole(F.col("v")).alias("x"))
    fit = settle(own.select("x").distinct())
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c"))
    widest = lengths.orderBy(F.desc("c"), F.desc("d")).first()
    if widest is None or not widest["d"]:
        return spark.createDataFrame([], f"`{key}` {kind}, {RESULT}")
    width = widest["d"]
    fit = fit.filter(F.size("x") == width)
    model = fitted(fit, width, components)
    error = identity_error(fit, width, model)
    k = len(model.values)
    explained = [float(v) / model.trace if model.trace else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("x")
            fits = np.diff(lists.offsets.to_numpy()) == width
            deviation, whitened = [None] * len(fits), [[None] * k] * len(fits)
            if fits.any():
                x = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                w = model.whitened(x).astype(object)
                w[:, ~model.valid] = None
                for i, d, row in zip(np.flatnonzero(fits).tolist(), model.deviations(x), w.tolist(), strict=True):
                    deviation[i], whitened[i] = d, row
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))],
                ["k", "deviation", "w"])

    made = own.mapInArrow(run, f"k {kind}, deviation long, w array<double>")
    shares = F.array(*[F.lit(e).cast("double") for e in explained])
    return made.select("k", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("k").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
