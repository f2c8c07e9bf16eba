"""Vectorised text work inside Arrow tasks: a batch's strings as one UTF-8 byte array.

A text column arrives in a task as one Arrow buffer plus offsets. The helpers
here cut it into slices of about a megabyte (always whole texts), find words,
and hash any span of bytes in constant time from one running sum, so that the
operators need no Python loop over words or characters. Memory per slice is a
small multiple of the slice or, for a longer text, of that one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Separators of ``[^\x20\x09-\x0D]+`` words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking odd 64-bit value for each byte; the second table maps A-Z to a-z first.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]

_powers = {_BASE: np.ones(1, np.uint64), _BASE_INV: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    if len(have) < n:
        have = np.full(max(n, 2 * SLICE_BYTES), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 1 << 24:  # keep tables of ordinary slices only
            _powers[base] = have
    return have[:n]


def powers(n: int) -> np.ndarray:
    """1, b, b**2, ... modulo 2**64."""
    return _power(_BASE, n)


def running_hash(values: np.ndarray) -> np.ndarray:
    """Sums of value[i] * b**i: from it :func:`span_hash` gets any span's hash."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * _power(_BASE, len(values)), out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): the same for equal content at any place."""
    inv = _power(_BASE_INV, len(running))
    return mix((running[end] - running[start]) * inv[start] + (end - start).astype(np.uint64))


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of whole texts; a null is an empty text.

    ``bounds`` has one more entry than there are rows: where each text starts
    in ``bytes``, and their end.
    """
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, firsts): maximal runs without separators; no word crosses
    two texts. Words firsts[i] to firsts[i + 1] are those of text i."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    edge[0] = edge[n] = True
    opens, closes = edge[:-1].copy(), edge[1:].copy()
    opens[1:] |= ~inside[:-1]
    closes[:-1] |= ~inside[1:]
    starts = np.flatnonzero(inside & opens)
    ends = np.flatnonzero(inside & closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)
