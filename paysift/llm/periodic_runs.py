"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4q) words that no neighbouring word extends. At each dyadic scale B the
text is cut into aligned blocks, and a number theoretic transform sums, exactly
modulo a prime, the squared differences between a block and every place of the
window that follows it at distances B to 2B - 1. A block's zero-mismatch places
give zero, always; a sum that is zero by chance is thrown out by the extension.
A run of period q in that range holds a whole block whose place q words on is in
the run, too, so every run gets a seed (block, distance) at its scale; the
longest common extension of both places, by running hashes and bisection, gives
its ends. Seeds at multiples of a period end at the same words as the run itself,
so of one stretch the smallest distance is its period.

Two exact tests save transforms: a block whose words don't all occur again
within 2B words has no zero-mismatch place in its window, and a block whose whole
window lies in a run that a smaller scale found can only find that run again.
Texts are cut into blocks at their own first word, so all work is local to a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm import bytesx

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A prime of the form k * 2**23 + 1 and its primitive root.
PRIME, ROOT = 998_244_353, 3
#: Longest block that is transformed as a whole; blocks of larger scales are compared by this much of them.
MAX_BLOCK = 1 << 16
#: Words per call of the transform: bounds the memory of a step.
STEP = 1 << 19


@lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 to half - 1 of a root of unity of order 2 * half."""
    w = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        w = pow(w, -1, PRIME)
    out = np.ones(half, np.uint64)
    filled = 1
    while filled < half:
        out[filled : 2 * filled] = out[:filled] * np.uint64(pow(w, filled, PRIME)) % np.uint64(PRIME)
        filled *= 2
    return out


def ntt(rows: np.ndarray) -> np.ndarray:
    """The transform of each row (length a power of two), in bit-reversed order."""
    p = np.uint64(PRIME)
    half = rows.shape[1] // 2
    while half:
        pairs = rows.reshape(len(rows), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([(a + b) % p, (a + p - b) * _twiddles(half, False) % p], axis=2).reshape(len(rows), -1)
        half //= 2
    return rows


def inverse_ntt(rows: np.ndarray) -> np.ndarray:
    """Undoes :func:`ntt`."""
    p, n = np.uint64(PRIME), rows.shape[1]
    half = 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * _twiddles(half, True) % p
        rows = np.stack([(a + b) % p, (a + p - b) % p], axis=2).reshape(len(rows), -1)
        half *= 2
    return rows * np.uint64(pow(n, -1, PRIME)) % p


def zero_mismatches(values: np.ndarray, at: np.ndarray, after: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shift): values[at:at + size] equals values[after + shift:] there, for shifts 0 to size - 1.

    Squared differences summed modulo PRIME: x*x + y*y - 2*x*y, the products by
    convolution with the reversed block. Values past the end count as 0.
    """
    p, n = np.uint64(PRIME), len(values)
    place = after[:, None] + np.arange(2 * size)
    window = np.where(place < n, values[np.minimum(place, n - 1)], np.uint64(0))
    block = np.zeros_like(window)
    block[:, :size] = values[at[:, None] + np.arange(size - 1, -1, -1)]
    products = inverse_ntt(ntt(block) * ntt(window) % p)[:, size - 1 : 2 * size - 1]
    squares = np.zeros((len(at), 2 * size + 1), np.uint64)
    np.cumsum(window * window % p, axis=1, out=squares[:, 1:])
    of_window = (squares[:, size : 2 * size] - squares[:, :size]) % p
    of_block = (block * block % p).sum(axis=1, keepdims=True) % p
    return np.nonzero((of_block + of_window + np.uint64(2) * (p - products)) % p == 0)


def _common(running: np.ndarray, at: np.ndarray, far: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``at`` and ``far`` on, to the right (step 1) or to the left (-1); at most ``most``."""
    low, high = np.zeros(len(at), np.int64), most.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        a, b, mid = at[open_], far[open_], (low[open_] + high[open_] + 1) // 2
        if step > 0:
            same = bytesx.span_hash(running, a, a + mid) == bytesx.span_hash(running, b, b + mid)
        else:
            same = bytesx.span_hash(running, a - mid, a) == bytesx.span_hash(running, b - mid, b)
        low[open_[same]] = mid[same]
        high[open_[~same]] = mid[~same] - 1
    return low


def _next_distance(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Words from each word to its next occurrence in its text; a large number if there is none."""
    key = bytesx.mix(words + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = key[order[1:]] == key[order[:-1]]
    out = np.full(len(words), np.iinfo(np.int64).max)
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def find_runs(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period. ``words`` are hashes of
    words; those of text i are firsts[i] to firsts[i + 1], and runs don't cross texts."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(firsts)
    if not len(words) or sizes.max() < LEAST_WORDS:
        return none, none, none
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = firsts[:-1][text], firsts[1:][text]
    running = bytesx.running_hash(words)
    values = words % np.uint64(PRIME)
    farthest = _next_distance(words, text)  # of the words of a block, kept for the block size of the scale
    covered = np.zeros(len(words) + 1, np.int64)  # where the known run ends that reaches farthest, by its start
    grid = np.arange(len(words))
    found = []
    scale = 1
    while LEAST_PERIODS * scale <= sizes.max():
        size = min(scale, MAX_BLOCK)
        grid = grid[((grid - begin[grid]) & (scale - 1)) == 0]
        grid = grid[end[grid] - begin[grid] >= max(LEAST_WORDS, LEAST_PERIODS * scale)]
        at = grid[grid + scale + size <= end[grid]]
        reach = np.maximum.accumulate(covered)
        at = at[(farthest[at] < 2 * scale) & (reach[at] < np.minimum(at + 3 * scale, end[at]))]
        pieces = scale // size
        rows = max(1, STEP // (2 * size))
        for i in range(0, len(at) * pieces, rows):
            part = np.arange(i, min(i + rows, len(at) * pieces))
            here, skip = at[part // pieces], scale + part % pieces * size
            row, shift = zero_mismatches(values, here, here + skip, size)
            here, distance = here[row], skip[row] + shift
            inside = here + distance + size <= end[here]
            here, distance = here[inside], distance[inside]
            right = _common(running, here, here + distance, end[here] - here - distance, 1)
            left = _common(running, here, here + distance, here - begin[here], -1)
            start, stop = here - left, here + distance + right
            long = (right >= size) & (stop - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * distance))
            found.append((start[long], stop[long], distance[long]))
            np.maximum.at(covered, start[long], stop[long])
        if size == scale and 2 * scale <= MAX_BLOCK:
            np.maximum(farthest[:-scale], farthest[scale:], out=farthest[:-scale])
        scale *= 2
    if not found:
        return none, none, none
    start, stop, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _row(words: list[bytes], start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> bytes:
    """The words without those that a run repeats after its first period."""
    if len(start):
        drops = np.zeros(len(words) + 1, np.int64)
        np.add.at(drops, start + period, 1)
        np.add.at(drops, stop, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(drops[:-1]) == 0)]
    return b" ".join(words)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, kept) for every row of ``docs`` (doc_id, text, any others).

    ``runs`` lists (start, length, period), numbered by words from 0, by start
    and then period. ``kept`` is the text's words, joined by one space, without
    those that any run holds after its first period. A null or blank text has
    no words, no runs and an empty ``kept``. Every row is looked at by itself:
    repeated rows come out alike, a null doc_id stays null, and an empty table
    gives no rows. Words agree when their 64-bit hashes do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in bytesx.slices(batch.column(1)):
                starts, ends, firsts = bytesx.word_spans(data, bounds, bytesx.SPACE)
                words = bytesx.span_hash(bytesx.running_hash(bytesx.BYTE_VALUE[data]), starts, ends)
                start, stop, period = find_runs(words, firsts)
                limits = np.searchsorted(start, firsts)
                limits[-1] = len(start)
                kept = []
                for i in range(end - row):
                    mine, first = slice(limits[i], limits[i + 1]), firsts[i]
                    kept.append(_row(data[bounds[i] : bounds[i + 1]].tobytes().split(), start[mine] - first, stop[mine] - first, period[mine]).decode())
                first = np.repeat(firsts[:-1], np.diff(limits))
                runs = pa.StructArray.from_arrays([pa.array(start - first), pa.array(stop - start), pa.array(period)], fields=list(_RUN))
                runs = pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), runs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(np.diff(firsts)), runs, pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "kept"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")
