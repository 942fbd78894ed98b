"""Vectorised text primitives over Arrow string columns.

The functions work on the UTF-8 bytes of many texts at once, as Arrow hands
them over: no per-word Python objects are made. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step takes (a longer text is a step of its own).
STEP_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), applied to each element."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix(codes + np.uint64(0x5851F42D4C957F2D))


VALUES = _byte_values(lower=False)
#: As VALUES, with A-Z valued like a-z.
VALUES_LOWER = _byte_values(lower=True)

#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, STEP_BYTES + 1)
        _powers, _inverse = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, p & _MASK, np.uint64))])
                             for p in (_P, _P_INV))
    return _powers[:n], _inverse


def steps(batches: Iterator[pa.RecordBatch], column: str,
          step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``step_bytes`` of text, so memory follows the step, not the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + step_bytes, "right")) - 1
            stop = min(batch.num_rows, max(start + 1, stop), start + 4096)
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and len + 1 offsets."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of member bytes: starts, ends (exclusive) and the row of each; no run crosses a row's end."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3
    inside = member[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]
    end[first[first > 0] - 1] = inside[first[first > 0] - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes (polynomial in mixed byte values, by prefix sums)."""
    power, inverse = _pow_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def order(hashes: np.ndarray) -> np.ndarray:
    """Stable order of hashes: their high bits with their places are sorted, which is faster than sorting places."""
    bits = np.uint64(max(1, (len(hashes) - 1).bit_length()))
    packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    out = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = hashes[out]
    # hashes that differ in the low bits alone
    return out[np.argsort(found, kind="stable")] if (found[1:] < found[:-1]).any() else out


def windows(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` consecutive words of one row, and the index of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[size - 1:])
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = mix(out + words[at + k] + np.uint64(k + 1))
    return out, at
