"""Vectors as whole numbers, and exact products of blocks of them; shared by the vector operators.

A shorter vector counts as followed by zeros wherever two lengths meet. Products are exact: doubles where every partial
sum is a whole number below 2**53, 64-bit integers below 2**63, Python integers beyond.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: str) -> Column:
    """Whether a vector takes part: not null, no component null, infinite or not a number."""
    inside = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(F.col(embedding).cast("array<double>"), inside), F.lit(False))


def whole_numbers(embedding: str, scale: int) -> Column:
    """floor(scale * x) of each component, as array<bigint>; of a ``usable`` vector only."""
    return F.transform(F.col(embedding).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a list column without nulls, filled with zeros to the longest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``left`` with all rows of ``right``, as int64."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = _peak(left) * _peak(right) * width
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return left @ right.T
    return (left.astype(object) @ right.astype(object).T).astype(np.int64)


def _peak(values: np.ndarray) -> int:
    return max(abs(int(values.min(initial=0))), abs(int(values.max(initial=0))))


def first_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest scores of each row, all if fewer; of equal scores the smaller column first.

    Scores of ``LEAST`` are none. Pairs come row by row, best first.
    """
    n, m = scores.shape
    keep = scores > LEAST
    if m > k:
        keep &= scores >= np.partition(scores, m - k, axis=1)[:, m - k, None]
    rows, columns = np.nonzero(keep)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


#: A score that no pair has: it marks pairs that do not count.
LEAST = np.iinfo(np.int64).min


def sql_numbers(scale: int) -> str:
    """DuckDB text of ``whole_numbers``, as doubles, which hold them exactly."""
    return f"list_transform(embedding, lambda x: floor({scale} * cast(x as double)))"


SQL_USABLE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
