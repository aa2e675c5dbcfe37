"""Vector columns of Arrow batches as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LARGEST = float(1 << 52)


def whole_numbers(column: pa.Array, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): the places of the usable vectors of a list column, and
    ``floor(factor * c)`` of their components, one row each. A vector is usable
    if it is not null and all its components are present and finite.

    Vectors of different lengths in one table are an error, as are components
    whose product is 2^52 or more: a double no longer holds them exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = column.flatten()      # those of the lists that are not null
    gap = values.is_null().to_numpy(zero_copy_only=False)
    c = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size >= 0)
    cut = np.concatenate([[0], np.cumsum(size[rows])])
    good = np.concatenate([[0], np.cumsum(gap | ~np.isfinite(c))])
    usable = good[cut[1:]] == good[cut[:-1]]
    rows, begin, size = rows[usable], cut[:-1][usable], size[rows][usable]
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    one_length(size)
    x = np.floor(factor * c[begin[:, None] + np.arange(size[0])])
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a vector's component times {factor} is 2^52 or more")
    return rows, x.astype(np.int64)


def one_length(size: np.ndarray) -> None:
    if len(size) and size.min() != size.max():
        raise ValueError("vectors of different numbers of components in one table")


def long_list(x: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(x).reshape(-1)))


def exact_squares(diff: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None beyond a long."""
    if not diff.size:
        return [0] * len(diff)
    if float(np.abs(diff).max()) ** 2 * diff.shape[1] < 2.0 ** 62:
        return (diff * diff).sum(1).tolist()
    sums = (diff.astype(object) ** 2).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in sums]
