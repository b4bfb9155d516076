"""Vectors from Arrow batches, and sums over all of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_length(vectors: DataFrame, column: str) -> int:
    """The length most vectors have, the least of several; 0 if there are none but null and empty ones."""
    sizes = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def finite_rows(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows with so many finite components, and these as a matrix in double precision."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    starts = column.offsets.to_numpy()[:-1][rows]
    found = values[starts[:, None] + np.arange(size)]
    good = np.isfinite(found).all(axis=1)
    return rows[good], found[good]


def scaled(vectors: np.ndarray, factor: int, limit: int) -> np.ndarray:
    """Components times a factor, rounded down, as integers between plus and minus a limit."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * factor), -limit, limit).astype(np.int64)
