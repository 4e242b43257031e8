"""Vectors as whole numbers, for the operators over the table ``embeddings``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Whole numbers below this are exact as doubles, and so are sums of products that stay below it.
EXACT = 2**53


def whole(column: pa.Array, scale: int, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``column`` (lists of numbers) that take part, and floor(``scale`` * x) of their components, as doubles.

    A vector that is null, or holds a null, NaN or infinite component, takes no part. Shorter vectors are filled up with
    zeros to ``dims``, the longest of the batch by default.
    """
    here = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.take(pa.array(here))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), max(int(sizes.max(initial=0)), dims or 0)))
    out[row, np.arange(len(row)) - first[row]] = values
    good = np.isfinite(out).all(axis=1)
    return here[good], np.floor(out[good] * scale)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's components as the bytes of 64-bit integers."""
    data = np.ascontiguousarray(rows, "<i8")
    offsets = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(blob: bytes, kind: str, dims: int) -> np.ndarray:
    return np.frombuffer(blob, kind).reshape(-1, dims)
