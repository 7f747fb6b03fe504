"""Whitening of embeddings by shifted CholeskyQR (Fukaya, Kannan, Nakatsukasa, Yamamoto and Yanagisawa 2020).

The centred rows A are never gathered. A pass sums the Gram matrix of A inv(R) over all tasks; its Cholesky factor joins
R on the left, so A inv(R) comes closer to orthogonal with each pass while A = Q R holds throughout. The first pass
adds a small shift, without which rounding could make the Gram matrix of a badly scaled A lose its positive sign. The
singular values of R are then those of A, at the accuracy of A itself rather than of its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import saved
from precis.llm.vectors import matrix, slices, whole_numbers

MOST_PASSES = 6
# A Gram matrix this close to the identity ends the passes; a direction of less than this share of the largest singular
# value is rounding of a dependent one.
ORTHOGONAL = 1e-13
NO_DIRECTION = 1e-11
_ROUNDING = 2.0**-53
_MOST_LONG = 2**63 - 1


@dataclass
class Whitening:
    """`n` fitted vectors with sums `total`; `components` as rows, their eigenvalues and the trace of the covariance."""

    n: int
    total: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - total, exactly, over n: in longs where they hold it, else in Python's whole numbers."""
    if not x.size:
        return x.astype(np.float64)
    low, high = int(x.min()), int(x.max())
    if n * max(abs(low), abs(high), 1) < 2**62:
        return (n * x - total).astype(np.float64) / n
    return ((x.astype(object) * n - total.astype(object)) / n).astype(np.float64)


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - total)^2; null where a long can't hold it."""
    if x.size and n * max(abs(int(x.min())), abs(int(x.max())), 1) < 2**62:
        gaps = n * x - total
        if int(np.abs(gaps).max()) ** 2 * x.shape[1] <= _MOST_LONG:
            return np.einsum("ij,ij->i", gaps, gaps).tolist()
    exact = ((x.astype(object) * n - total.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v <= _MOST_LONG else None for v in exact]


def _summed(rows: DataFrame, size: int, of, width: int) -> np.ndarray:
    """Sum of `of(x)`, an array of `width` doubles, over batches of all rows.

    Each task sends one row of sums, so the driver gets one row of totals whatever the number of rows.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width)
        for batch in slices(batches, size):
            held += of(matrix(batch.column("x"), size)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("x").mapInArrow(partial, "sums array<double>")
    places = parts.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(width)
    for at, value in places.collect():  # `width` rows
        out[at] = value
    return out


def fit(distinct: DataFrame, size: int, most: int = 16) -> Whitening:
    """The whitening of the rows `x` of a table: each counts once, `size` components each.

    Directions in which the rows don't vary (fewer rows than dimensions, constant or dependent dimensions) are no
    components, so there may be fewer than `most`.
    """
    # Sums as whole numbers, a row per dimension.
    places = distinct.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.count("*").alias("n")).collect()
    n = places[0]["n"] if places else 0
    total = np.array([int(r["value"]) for r in sorted(places, key=lambda r: r["at"])], object)
    if not n:
        return Whitening(0, np.zeros(size, np.int64), np.zeros((0, size)), np.zeros(0), 0.0)
    total = total.astype(np.int64) if max(abs(t) for t in total) < 2**63 else total

    def gram(back: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            q = _solved(_centred(x, n, total), back)
            return q.T @ q

        return _summed(distinct, size, of, size * size).reshape(size, size)

    factors: list[np.ndarray] = []
    first = square = gram(np.zeros((0, size, size)))
    trace = float(np.trace(first)) / n
    for done in range(MOST_PASSES):
        if trace == 0 or (factors and np.abs(square - np.eye(size)).max() < ORTHOGONAL):
            break
        if done == 0:
            # Larger than what rounding can do to the sums, and far below the largest singular value.
            shift = 11 * (n * size + size * (size + 1)) * _ROUNDING * np.trace(first)
            shift = min(shift, 1e-6 * np.trace(first))
        else:
            # Zero for independent columns: those of dependent ones need a little to have a factor at all.
            shift = 0.0 if np.linalg.eigvalsh(square)[0] > 1e-8 else 1e-8
        factors.append(np.linalg.cholesky(square + shift * np.eye(size)).T)
        square = gram(np.array(factors))
    if trace == 0:
        return Whitening(n, total, np.zeros((0, size)), np.zeros(0), 0.0)
    # A = Q R with Q's Gram matrix `square`: its root (the identity, but for dependent columns) times R has A's
    # singular values and right vectors.
    values, vectors = np.linalg.eigh(square)
    r = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, sizes, right = np.linalg.svd(r)
    rank = min(int((sizes > NO_DIRECTION * sizes[0]).sum()), n - 1, most)
    components = right[:rank]
    # Either sign will do: the largest entry is positive.
    components = components * np.sign(components[np.arange(rank), np.abs(components).argmax(axis=1)])[:, None]
    return Whitening(n, total, components, sizes[:rank] ** 2 / n, trace)


def _solved(a: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A inv(R1) inv(R2) ... by triangular systems, R of upper triangles."""
    for factor in factors:
        a = _times_inverse(a, factor)
    return a


def _times_inverse(a: np.ndarray, upper: np.ndarray, block: int = 64) -> np.ndarray:
    """X with X R = A by substitution, a block of columns at a time."""
    out = np.empty_like(a)
    for at in range(0, len(upper), block):
        end = min(at + block, len(upper))
        rest = a[:, at:end] - out[:, :at] @ upper[:at, at:end]
        out[:, at:end] = np.linalg.solve(upper[at:end, at:end].T, rest.T).T
    return out


def projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened coordinates of whole-numbered vectors."""
    return (_centred(x, w.n, w.total) @ w.components.T) / np.sqrt(w.values)


def identity_error(distinct: DataFrame, size: int, w: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, by one more pass over all of them."""
    rank = len(w.values)
    if not rank:
        return 0.0

    def of(x: np.ndarray) -> np.ndarray:
        z = projected(x, w)
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

    sums = _summed(distinct, size, of, rank * rank + rank) / w.n
    mean = sums[rank * rank :]
    return float(np.abs(sums[: rank * rank].reshape(rank, rank) - np.outer(mean, mean) - np.eye(rank)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, offset: int = 1_000_000, most: int = 16) -> DataFrame:
    """`(_key, component, n, deviation, whitened, explained, identity_error)` per usable row and component.

    A vector becomes longs, floor(scale * c) + offset. Each distinct one counts once in the fit, so a vector that many rows
    share weighs no more than others; copies are combined before the shuffle. Rows whose vector is null or holds null, NaN
    or infinite entries are left out; a shorter vector goes on with the offset; keys may be null or repeat, each row
    comes out. Components are numbered from 1 by falling eigenvalue, at most `most`, and fewer where the rows vary in
    fewer directions: one distinct vector or an empty table gives no rows. `deviation` is null where a long can't hold it.
    Other columns are not looked at.
    """
    every, size = whole_numbers(df, key, vector, scale, offset)
    every = saved(every, "whole-vectors")
    distinct = saved(every.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "distinct-vectors")
    w = fit(distinct, size, most)
    error = identity_error(distinct, size, w)
    rank = len(w.values)
    explained = np.tile(w.values / w.trace if rank else w.values, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max(size, 16 * rank)):
            x = matrix(batch.column("x"), size)
            if not rank or not len(x):
                continue
            n = len(x) * rank
            keys = batch.column("_key").take(pa.array(np.repeat(np.arange(len(x)), rank)))
            deviation = pa.array(_deviations(x, w.n, w.total), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), rank)))
            fields = [keys, pa.array(np.tile(np.arange(1, rank + 1), len(x)), pa.int32()), pa.array(np.full(n, w.n)), deviation, pa.array(projected(x, w).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(n, error))]
            yield pa.RecordBatch.from_arrays(fields, names=["_key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = every.schema["_key"].dataType.simpleString()
    return every.mapInArrow(rows, f"_key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
