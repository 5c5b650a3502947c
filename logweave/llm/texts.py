"""Words, lines and hashes of whole Arrow batches of texts with numpy.

Texts are handled as UTF-8 bytes in chunks of about ``CHUNK_BYTES`` (a longer text is a chunk of its
own), so memory does not depend on the batch.  Word separators are ASCII and never occur inside
another character's bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, U)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int32 if pa.types.is_string(column.type) else np.int64
    off = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges ``(lo, hi, data, offsets)`` of about ``CHUNK_BYTES``; offsets start at 0."""
    data, off = raw(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK_BYTES, "right")) - 1)
        yield lo, hi, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 4096), _BASE, U)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross a text: starts, ends, text index."""
    if not inside.size:
        none = np.zeros(0, np.int64)
        return none, none, none
    full = offsets[:-1] < offsets[1:]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][full]
    first[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[1:][full] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~SPACE[data], offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (spans are not empty)."""
    if not len(starts):
        return np.zeros(0, U)
    size = ends - starts
    begin = np.cumsum(size) - size
    pos = np.arange(int(size.sum())) - np.repeat(begin, size)
    value = (data[pos + np.repeat(starts, size)].astype(U) + U(1)) * powers(int(size.max()))[pos]
    return mix(np.add.reduceat(value, begin) + size.astype(U) * U(_BASE))


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive values within one text, and where each window starts."""
    if len(h) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    n = len(h) - k + 1
    g = np.zeros(n, U)
    for i in range(k):
        g = mix(g * U(_BASE) + h[i: i + n] + U(i + 1))
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return g[at], at
