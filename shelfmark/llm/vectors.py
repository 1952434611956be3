"""Vectors of whole numbers from columns of floating-point arrays, as the vector operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Whole numbers of this size and more aren't exact in double precision.
EXACT = 1 << 53


def parts(arrays: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows aren't null, all components one after the other as doubles (null as NaN), and the rows' lengths (0 for null)."""
    if isinstance(arrays, pa.ChunkedArray):
        arrays = arrays.combine_chunks()
    present = np.array(arrays.is_valid().to_numpy(zero_copy_only=False))
    sizes = arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = arrays.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return present, flat, sizes


def whole(arrays: pa.Array, scale: int, most: float = 2.0**62) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """floor(scale * component) of the rows that hold a vector: for each length, the rows' places and a matrix of int64.

    Numbers beyond `most` in size count as `most`.
    """
    ok, flat, sizes = parts(arrays)
    ok[np.repeat(np.arange(len(sizes)), sizes)[~np.isfinite(flat)]] = False
    starts = np.cumsum(sizes) - sizes
    out = {}
    for n in np.unique(sizes[ok]).tolist():
        rows = np.flatnonzero(ok & (sizes == n))
        with np.errstate(over="ignore"):
            numbers = np.floor(flat[starts[rows][:, None] + np.arange(n)] * float(scale))
        out[n] = (rows, np.clip(numbers, -most, most).astype(np.int64))
    return out
