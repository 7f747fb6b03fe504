"""Embedding columns as rows of whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A batch holds about this many components, whatever the number of rows that Arrow hands over.
_AT_ONCE = 1 << 20


def usable(vector: Column) -> Column:
    """True for vectors that are there and hold finite numbers only; an empty vector holds none that isn't."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def whole_numbers(df: DataFrame, key: str, vector: str, scale: int, offset: int = 0) -> tuple[DataFrame, int]:
    """`(_key, x)` of the usable rows, x the longs floor(scale * c) + offset; and the length of the vectors.

    The length is the longest of all rows; a shorter vector goes on with zeros. Components must fit a long when scaled.
    """
    rows = df.filter(usable(F.col(f"`{vector}`"))).select(F.col(f"`{key}`").alias("_key"), F.col(f"`{vector}`").alias("_v"))
    size = rows.agg(F.max(F.size("_v"))).first()[0] or 0  # one row
    scaled = F.transform("_v", lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))
    filled = F.concat(scaled, F.array_repeat(F.lit(offset).cast("long"), F.lit(size) - F.size("_v")))
    return rows.select("_key", filled.alias("x")), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of longs."""
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), size)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, size = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(rows.ravel()))


def slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded size."""
    step = max(1, _AT_ONCE // max(1, size))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
