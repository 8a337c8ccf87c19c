"""Whitening of embeddings; principal components by contour integration.

Spark counts, sums and centres the vectors and adds up their covariance, a matrix
whose size depends on the dimensions alone. Its spectrum is cut into intervals of a
few eigenvalues each, every interval is a task: a quadrature of complex shifted
solves ``(z I - V)^-1 Y`` around it projects a block of vectors onto its
eigenvectors, and a Rayleigh-Ritz step extracts them, repeated until they no longer
improve. How many eigenvalues an interval holds is known beforehand: the inertia of
``V - s I``, read off the pivots of its tridiagonal form, counts those below ``s``.
An interval that yields fewer is solved again with a larger block, so none is missed.

A component ``c`` enters as the integer ``x = floor(scale * c) + offset``. Sums are
exact, ``n * x - S`` is exact, and only then does arithmetic turn to doubles, so
values are centred before anything is multiplied.

Edge cases: rows whose vector is null, empty, or holds null or non-finite entries are
dropped; so are vectors of another length than the most frequent one (of equally
frequent ones, the longest), for which there is no common covariance. Repeated rows
and repeated or null ids count and return like any other. Components without variance
(eigenvalue zero to rounding) have ``whitened`` null and ``explained`` 0; if all are
so, ``identity_error`` is 0. ``deviation`` is null where it exceeds a long. No usable
row, no result. Integer components are cut at 2^62. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.vectors import matrices, scaled

SCALE, OFFSET = 64, 1_000_000  # fixed values of the integer form
NODES = 8  # quadrature points on the upper half of a contour
MOST_IN_INTERVAL = 8  # eigenvalues an interval is split down to
_ROUNDS = 60
_EPS = np.finfo(float).eps


# --- spectrum of a symmetric matrix ---------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += math.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        v = x / size
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: negative pivots of the shifted matrix (Sylvester's law of inertia)."""
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (beside[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0.0:
            pivot = -_EPS * _EPS
        count += int(pivot < 0)
    return count


@dataclass(frozen=True)
class Interval:
    """Part of the spectrum ``[low, high)`` and the number of eigenvalues in it."""

    low: float
    high: float
    count: int


def intervals(diagonal: np.ndarray, beside: np.ndarray, wanted: int, floor: float) -> list[Interval]:
    """Intervals that hold at least the ``wanted`` largest eigenvalues above ``floor``, from the top."""
    below = lambda s: count_below(diagonal, beside, s)

    def middle(low: float, high: float) -> float:
        """A place near the middle with no eigenvalue close by, if there is one."""
        for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65):
            at = low + share * (high - low)
            room = 1e-3 * (high - low)
            if below(at - room) == below(at + room):
                break
        return at

    top = float(np.max(np.abs(diagonal) + np.append(np.abs(beside), 0) + np.append(0, np.abs(beside)))) * (1 + 1e-9)
    open_, done, found = [(floor, top, below(floor), below(top))], [], 0
    while open_ and found < wanted:
        low, high, under, until = open_.pop()
        if until == under:
            continue
        if until - under <= MOST_IN_INTERVAL or high - low < 1e-9 * top:
            done.append(Interval(low, high, until - under))
            found += until - under
            continue
        at = middle(low, high)
        between = below(at)
        open_ += [(low, at, under, between), (at, high, between, until)]
    return done


def in_interval(matrix: np.ndarray, part: Interval, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``matrix`` in ``part``, as many as it must hold."""
    n = len(matrix)
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(-0.5j * np.pi * (nodes - 1))
    unit = np.eye(n)
    norm = np.max(np.abs(matrix).sum(axis=0))
    columns = min(n, part.count + 4 + part.count // 2)
    while True:
        block = np.random.default_rng(seed).standard_normal((n, columns))
        best, found, idle = math.inf, None, 0
        for _ in range(_ROUNDS):
            projected = np.zeros((n, columns))
            for turn, weight in zip(turns, weights):
                solved = np.linalg.solve((centre + radius * turn) * unit - matrix, block.astype(complex))
                projected += 0.5 * weight * (radius * turn * solved).real
            basis, _ = np.linalg.qr(projected)
            values, rotation = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ rotation
            inside = np.flatnonzero((values >= part.low) & (values < part.high))
            if len(inside) < part.count:
                continue
            # Vectors outside that stray in have the larger residuals.
            residuals = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            inside = inside[np.sort(np.argsort(residuals)[: part.count])]
            worst = float(np.sort(residuals)[part.count - 1])
            idle = 0 if worst < best / 2 else idle + 1
            if worst < best:
                best, found = worst, (values[inside], block[:, inside])
            if best <= _EPS * norm or idle > 2:
                break
        if found is not None and (best <= 100 * n * _EPS * norm or columns == n):
            return found
        if columns == n:
            raise ArithmeticError(f"{part.count} eigenvalues counted in [{part.low}, {part.high}), fewer found")
        columns = min(n, 2 * columns)


def leading(spark, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above zero, falling, and their eigenvectors as columns.

    Each interval of the spectrum is solved by a task of its own.
    """
    norm = float(np.max(np.abs(matrix).sum(axis=0))) if len(matrix) else 0.0
    none = np.zeros(0), np.zeros((len(matrix), 0))
    if not norm > 0:
        return none
    matrix = matrix / norm
    floor = 8 * len(matrix) * float(_EPS)
    parts = intervals(*tridiagonal(matrix), wanted, floor)
    if not parts:
        return none

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low, high, count in zip(frame["low"], frame["high"], frame["count"]):
                values, vectors = in_interval(matrix, Interval(low, high, int(count)))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    table = spark.createDataFrame([(p.low, p.high, p.count) for p in parts], "low double, high double, count int")
    solved = table.repartition(len(parts), "low").mapInPandas(solve, "value double, vector array<double>").collect()
    if len(solved) != sum(p.count for p in parts):
        raise ArithmeticError(f"{sum(p.count for p in parts)} eigenvalues counted, {len(solved)} found")
    # Vectors of neighbouring intervals are made orthogonal to the last digit together.
    together = np.array([s["vector"] for s in sorted(solved, key=lambda s: -s["value"])]).T
    basis, _ = np.linalg.qr(together)
    values, rotation = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:wanted]
    vectors = basis @ rotation[:, order]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))])
    return values[order] * norm, vectors * signs


# --- the vectors ------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """What whitening needs to know of the fit list; sizes depend on the dimensions only."""

    n: int
    sums: tuple[int, ...]
    wanted: int  # components to return
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _integers(matrix: np.ndarray) -> np.ndarray:
    return scaled(matrix, SCALE) + OFFSET


def _offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit integers where they suffice, else Python's."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums)) if x.size else 0
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _of_length(column: pa.ListArray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    for rows, matrix in matrices(column):
        if matrix.shape[1] == dimensions:
            return rows, _integers(matrix)
    return np.zeros(0, np.int64), np.zeros((0, dimensions), np.int64)


def _lengths(rows: DataFrame, column: str) -> DataFrame:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf)
    usable = rows.where(F.forall(F.col(column).cast("array<double>"), finite) & (F.size(column) > 0))
    return usable.groupBy(F.size(column).alias("length")).count()


def _sums(vectors: DataFrame, dimensions: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and the exact sum of each dimension, from high and low halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64)
        for batch in batches:
            _, x = _of_length(batch.column(0), dimensions)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(np.full(dimensions, n)), pa.array(high), pa.array(low)],
                ["place", "n", "high", "low"],
            )

    exact = lambda c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c)
    parts = vectors.mapInArrow(run, "place int, n long, high long, low long")
    found = parts.groupBy("place").agg(exact("n"), exact("high"), exact("low")).orderBy("place").collect()
    return int(found[0]["n"]), tuple((int(r["high"]) << 32) + int(r["low"]) for r in found)


def _gram(vectors: DataFrame, dimensions: int, rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of the outer products of ``rows_of(x)``, added up by task and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            _, x = _of_length(batch.column(0), dimensions)
            y = rows_of(x)
            total += y.T @ y
        i, j = np.triu_indices(width)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"]
            )

    found = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def fit(rows: DataFrame, column: str = "embedding", components: int = 32) -> Fit | None:
    """Sums, covariance and leading components of the usable vectors; None if there are none."""
    lengths = _lengths(rows, column).orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    if not lengths:
        return None
    vectors, dimensions = rows.select(F.col(column).cast("array<double>")), lengths[0]["length"]
    n, sums = _sums(vectors, dimensions)
    centred = lambda x: (_offsets(x, n, sums) / n).astype(float)
    covariance = _gram(vectors, dimensions, centred, dimensions) / n
    wanted = min(components, dimensions)
    values, axes = leading(rows.sparkSession, covariance, wanted)
    return Fit(n, sums, wanted, float(np.trace(covariance)), values, axes)


def identity_error(rows: DataFrame, by: Fit, column: str = "embedding") -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over components with variance."""
    width = len(by.values)
    if not width:
        return 0.0
    n, sums, projection = by.n, by.sums, by.projection
    whitened = lambda x: (_offsets(x, n, sums) / n).astype(float) @ projection
    covariance = _gram(rows.select(F.col(column).cast("array<double>")), by.dimensions, whitened, width) / n
    return float(np.max(np.abs(covariance - np.eye(width))))


def transform(rows: DataFrame, by: Fit, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, deviation, whitened`` (one value per component) of every usable row."""
    n, sums, projection, width = by.n, by.sums, by.projection, by.wanted
    missing = width - len(by.values)

    def squares(t: np.ndarray) -> pa.Array:
        largest = int(np.max(np.abs(t))) if t.size else 0
        if t.dtype != object and len(sums) * largest**2 < 2**63:
            return pa.array((t * t).sum(axis=1))
        exact = [sum(int(v) ** 2 for v in row) for row in t]
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _of_length(batch.column(1), len(sums))
            if not len(at):
                continue
            t = _offsets(x, n, sums)
            whitened = np.hstack(((t / n).astype(float) @ projection, np.full((len(at), missing), np.nan)))
            flat = pa.array(whitened.ravel(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), squares(t), lists], [key, "deviation", "whitened"])

    own = rows.select(key, F.col(column).cast("array<double>").alias(column))
    return own.mapInArrow(run, f"{key} {own.schema[key].dataType.simpleString()}, deviation long, whitened array<double>")


def whiten(rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 32) -> DataFrame:
    """One row per usable row and component: ``key, component, n, deviation, whitened, explained, identity_error``."""
    kind = rows.schema[key].dataType.simpleString()
    by = fit(rows, column, components)
    if by is None:
        names = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], f"{key} {kind}, {names}")
    error = identity_error(rows, by, column)
    shares = [float(v) / by.trace for v in by.values] + [0.0] * (by.wanted - len(by.values))
    explained = F.array(*[F.lit(s) for s in shares])
    found = transform(rows, by, key, column).select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return found.select(
        key,
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(by.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
