"""Vectors of an Arrow batch as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Beyond this an integer component is cut to it, so that conversions are defined.
LARGEST = 2**62


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` of the usable vectors, once per length.

    A vector is usable if it is not null, not empty and holds finite numbers only.
    """
    offsets = column.offsets.to_numpy().astype(np.int64)
    begin = offsets[0] if len(offsets) else 0
    values = column.values.slice(begin, (offsets[-1] if len(offsets) else 0) - begin)
    flat = np.asarray(pc.fill_null(values.cast(pa.float64()), np.nan))
    offsets = offsets - begin
    sizes = np.diff(offsets)
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    usable = np.asarray(column.is_valid()) & (sizes > 0) & (wrong[offsets[1:]] == wrong[offsets[:-1]])
    for size in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == size))
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def scaled(matrix: np.ndarray, factor: int) -> np.ndarray:
    """``floor(factor * component)`` as 64-bit integers."""
    with np.errstate(over="ignore"):
        found = np.floor(matrix * factor)
    near = np.clip(found, -float(LARGEST), float(LARGEST))
    return near.astype(np.int64)
