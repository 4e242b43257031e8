"""Whole batches of texts as numpy arrays: bytes, words, rolling hashes, and the pieces cut at minimisers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


#: A 64-bit number for each byte.
BYTE_HASH = mix(np.arange(1, 257, dtype=U) * U(_BASE))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, U), np.full(n, _INVERSE, U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


class Ranges:
    """Hashes of ranges of a sequence: equal where the members are, wherever the ranges lie."""

    def __init__(self, units: np.ndarray):
        size = 1 << max(10, int(len(units)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(units) + 1, U)
        np.cumsum(units * up[: len(units)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and where each begins; one more for the end. Null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and len(offsets) else np.zeros(0, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are ``inside``, white space not being so), and each text's first word."""
    n = len(data)
    flag = np.zeros(n + 1, bool)
    flag[:n] = ~IS_SPACE[data] if inside is None else inside[data]
    begins = flag[:n].copy()
    begins[1:] &= ~flag[: n - 1]
    edges = bounds[bounds < n]
    begins[edges] = flag[edges]
    stops = flag[:n] & ~flag[1:]
    cut = bounds[(bounds > 0) & (bounds <= n)] - 1
    stops[cut] = flag[cut]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        lo, hi = starts[i], ends[j - 1]
        out[i:j] = Ranges(BYTE_HASH[data[lo:hi]]).of(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out


def grams(units: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` members; a power of two."""
    if size & (size - 1):
        raise ValueError("the gram size must be a power of two")
    base, length = _BASE, 1
    while length < size:
        units = units[:-length] * U(base) + units[length:]
        base, length = base * base % 2**64, length * 2
    return mix(units)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while length * 2 <= width:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    return np.minimum(x[: len(x) - (width - length)], x[width - length :]) if length < width else x


def chunks(bounds: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text + 1, from, to): groups of whole texts of about ``size`` units; a longer text in overlapping parts."""
    d, n = 0, len(bounds) - 1
    while d < n:
        e = int(np.searchsorted(bounds, bounds[d] + size, side="right")) - 1
        if e > d:
            yield d, e, int(bounds[d]), int(bounds[e])
            d = e
        else:
            low, high = int(bounds[d]), int(bounds[d + 1])
            for a in range(low, high, size):
                yield d, d + 1, a, min(high, a + size + overlap)
                if a + size + overlap >= high:
                    break
            d += 1


def pieces(units: np.ndarray, bounds: np.ndarray, window: int, gram: int, longest: int) -> dict[str, np.ndarray] | None:
    """Runs of consecutive windows with one minimiser: the smallest gram hash inside a window.

    ``row``, ``start`` and ``n`` (windows) tell where, ``mini`` is the minimiser, ``piece`` a hash of all the run's
    units, ``loops`` whether the minimiser stands in it more than once. Equal windows have equal minimisers.
    """
    total = len(units)
    if total < window:
        return None
    width = window - gram + 1
    g = grams(units, gram)
    least = sliding_min(g, width)
    m = len(least)
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    valid = row_of[:m] == row_of[window - 1 :]
    edge = np.empty(m + 1, bool)
    edge[0] = edge[m] = True
    edge[1:m] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    at = np.flatnonzero(edge)
    start, n = at[:-1], np.diff(at)
    good = valid[start]
    start, n = start[good], n[good]
    if len(n) and n.max() > longest:
        parts = -(-n // longest)
        first = np.repeat(np.cumsum(parts) - parts, parts)
        k = np.arange(len(first)) - first
        start, left = np.repeat(start, parts) + k * longest, np.repeat(n, parts) - k * longest
        n = np.minimum(left, longest)
    if not len(start):
        return None
    mini = least[start]
    inside = np.lib.stride_tricks.sliding_window_view(g, width)
    first_at = start + (inside[start] == mini[:, None]).argmax(1)
    last = start + n - 1
    last_at = last + width - 1 - (inside[last][:, ::-1] == mini[:, None]).argmax(1)
    return {
        "row": row_of[start],
        "start": start,
        "n": n,
        "mini": mini.view(np.int64),
        "piece": Ranges(units).of(start, start + n - 1 + window).view(np.int64),
        "loops": first_at != last_at,
    }


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, least_bytes: int) -> Iterator[pa.Table]:
    """Batches that are sorted by ``key`` as tables of some size that part no key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) < least_bytes:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def groups(*sorted_columns: np.ndarray) -> np.ndarray:
    """The number of each row's group, for columns of which equal rows stand together."""
    new = np.zeros(len(sorted_columns[0]), bool)
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)
