"""Substring deduplication by sliding spans of sentences.

A sentence ends at a word that ends with '.', '!' or '?' (closing quotes and
brackets may follow), after a Unicode sentence end such as the ideographic full
stop or the danda, with or without white space after it, or at a line end. Every
run of SPAN consecutive sentences is hashed (case of A-Z and white space don't
count), a text of fewer sentences as one run. As a passage may hold no SPAN whole
sentences, so are, on demand, shorter runs of at least FEW_WORDS words; a
stretch of LONG words or more without a sentence end is then cut into parts that count
as sentences: after words picked by their own hash, so that a passage is cut
alike wherever it stands, and after LONG words at the latest. Equal hashes meet in a global
count, summed before the shuffle. The first occurrence of a run stays, by doc_id and then by
place; every sentence that a later occurrence covers is removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm import bytesx
from paysift.llm.store import table

SPAN = 3
#: Least words of a run that is hashed. The registered query hashes every run and short texts as one.
MIN_WORDS = 12
#: Least words of a run of fewer than SPAN sentences; words without a stop that are cut, and the cut's mean length.
FEW_WORDS, LONG, PART = 20, 50, 8
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
#: What may close a quotation or bracket after a stop, and stops that need no white space after them.
_CLOSERS = [c.encode() for c in "\"')]}»›”’」』】）〉》"]
_WIDE_STOPS = [c.encode() for c in "。！？｡．।॥؟۔።፧፨՜՞។៕၊။‼⁇⁈⁉…"]


def _ends_with(data: np.ndarray, ends: np.ndarray, least: np.ndarray, tails: list[bytes]) -> np.ndarray:
    """Length of the one of ``tails`` that stands right before ``ends`` and after ``least``; else 0."""
    out = np.zeros(len(ends), np.int64)
    for tail in tails:
        met = ends - least >= len(tail)
        for i, byte in enumerate(reversed(tail), 1):
            met &= data[np.maximum(ends - i, 0)] == byte
        out[met] = len(tail)
    return out


def _stops(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for the words that end a sentence."""
    at, open_ = ends.copy(), np.arange(len(ends))
    while len(open_):  # closers come off, one at a time
        size = _ends_with(data, at[open_], starts[open_], _CLOSERS)
        at[open_] -= size
        open_ = open_[size > 0]
    left = at > starts
    stop = left & _ENDS[data[np.maximum(at - 1, 0)]]
    return stop | (_ends_with(data, at, starts, _WIDE_STOPS) > 0)


def _cut_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, cut after each wide stop (and the stops and closers after it) inside of them."""
    cut = np.zeros(len(data) + 1, bool)  # a word may be cut before this byte
    lead = np.flatnonzero((data == 0xE3) | (data == 0xEF) | (data == 0xE0) | (data == 0xE1) | (data == 0xE2) | (data == 0xD8) | (data == 0xDB) | (data == 0xD5))
    if not len(lead):
        return starts, ends
    where = np.searchsorted(starts, lead, "right") - 1
    for tail in _WIDE_STOPS:
        at = lead + len(tail)
        met = (where >= 0) & (at <= ends[np.maximum(where, 0)])
        for i, byte in enumerate(tail):
            met &= data[np.minimum(lead + i, len(data) - 1)] == byte
        cut[at[met]] = True
    for place in np.flatnonzero(cut):  # rare: goes on over what belongs to the stop
        cut[place] = False
        word = np.searchsorted(starts, place - 1, "right") - 1
        to, end = place, ends[word]
        rest = data[to:min(end, to + 64)].tobytes()
        while tail := next((t for t in (*_CLOSERS, *_WIDE_STOPS) if rest.startswith(t)), b""):
            to, rest = to + len(tail), rest[len(tail) :]
        if to < end:
            cut[to] = True
    inner = np.flatnonzero(cut)
    return np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))


def _cut_stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, stop: np.ndarray) -> None:
    """Mark further stops in stretches of LONG words or more that have none."""

    def far() -> tuple[np.ndarray, np.ndarray]:
        """(words in stretches of LONG or more, their place in it)"""
        first = np.concatenate([[0], np.flatnonzero(stop[:-1]) + 1])
        size = np.diff(np.append(first, len(stop)))
        place = np.arange(len(stop)) - np.repeat(first, size)
        words = np.flatnonzero(np.repeat(size, size) >= LONG)
        return words, place[words]

    words, _ = far()
    if not len(words):
        return
    h = np.empty(len(words), np.uint64)
    for i in range(0, len(words), 1 << 16):
        some = words[i : i + (1 << 16)]
        lo, hi = starts[some[0]], ends[some[-1]]
        running = bytesx.running_hash(bytesx.LOWER_VALUE[data[lo:hi]])
        h[i : i + len(some)] = bytesx.span_hash(running, starts[some] - lo, ends[some] - lo)
    stop[words[h % np.uint64(PART) == 0]] = True
    words, place = far()
    stop[words[place % LONG == LONG - 1]] = True


def sentences(data: np.ndarray, bounds: np.ndarray, cut_stretches: bool = False):
    """(word starts, word ends, first word of each sentence and the end, text of each sentence)."""
    starts, ends, firsts = bytesx.word_spans(data, bounds, bytesx.SPACE)
    if not len(starts):
        return starts, ends, np.zeros(1, np.int64), np.zeros(0, np.int64)
    starts, ends = _cut_words(data, starts, ends)
    firsts = np.searchsorted(starts, bounds)
    stop = _stops(data, starts, ends)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    stop[:-1] |= lines[starts[1:]] > lines[ends[:-1]]
    stop[firsts[1:][firsts[1:] > 0] - 1] = True  # no sentence goes on into the next text
    if cut_stretches:
        _cut_stretches(data, starts, ends, stop)
    first = np.concatenate([[0], np.flatnonzero(stop) + 1])
    text = np.searchsorted(firsts, first[:-1], "right") - 1
    return starts, ends, first, text


def _span_rows(docs: DataFrame, span: int, min_words: int, short: bool, few_words: int | None) -> DataFrame:
    """(h, doc_id, th, place) of every run of sentences: those of ``span``; with ``few_words``, shorter ones of so many words;
    with ``short``, whole texts of fewer sentences. ``place`` is the first sentence times (span + 1), plus the run's length."""

    def run(batches):
        for batch in batches:
            for row, _, data, bounds in bytesx.slices(batch.column(2)):
                starts, ends, first, text = sentences(data, bounds, few_words is not None)
                n = max(len(text) - span + 1, 0)
                if not len(text):
                    continue
                words = bytesx.span_hash(bytesx.running_hash(bytesx.LOWER_VALUE[data]), starts, ends)
                # the words of a run, sentence limits included: they are part of the words
                lo = np.flatnonzero(text[:n] == text[len(text) - n :])
                lo = lo[first[lo + span] - first[lo] >= min_words]
                runs = [(lo, lo + span)]
                for k in range(1, span if few_words is not None else 1):
                    lo = np.arange(max(len(text) - k + 1, 0))
                    lo = lo[(text[lo] == text[lo + k - 1]) & (first[lo + k] - first[lo] >= few_words)]
                    runs.append((lo, lo + k))
                if short:
                    begins, counts = np.unique(text, return_index=True, return_counts=True)[1:]
                    size = first[begins + counts] - first[begins]
                    few = (counts < span) & (size >= min_words) & (few_words is None or size < few_words)
                    runs.append((begins[few], (begins + counts)[few]))
                lo, hi = (np.concatenate(x) for x in zip(*runs))
                h = bytesx.span_hash(bytesx.running_hash(words), first[lo], first[hi])
                place = (lo - np.searchsorted(text, text[lo])) * (span + 1) + hi - lo
                rows = pa.array(text[lo] + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place)], names=["h", "doc_id", "th", "place"]
                )

    return docs.mapInArrow(run, "h long, doc_id long, th long, place long")


def remove_repeated_sentences(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, short: bool = False, few_words: int | None = None) -> DataFrame:
    """(doc_id, n_sentences, n_removed, kept_sha256, kept) for every row of ``docs`` (doc_id, text, any others).

    ``kept`` is the text without the removed sentences and the white space
    after them. A null text is empty; a text of fewer than ``span`` sentences
    is one run with ``short``, else it stays. ``few_words`` adds runs of fewer
    than ``span`` sentences and so many words, and cuts long stretches. A null doc_id comes before all others. Rows that
    agree in doc_id and text (by 64-bit hash) are one document: they are changed alike, and copies without a
    doc_id are not told apart. An empty table gives no rows.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = table(_span_rows(docs, span, min_words, short, few_words))
    seen = rows.groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "place")).alias("one")).where("c > 1")
    later = rows.join(seen.select("h", "one"), "h").where(F.struct("doc_id", "th", "place") != F.col("one"))
    covered = later.groupBy("doc_id", "th").agg(F.collect_set("place").alias("places"))

    def run(batches):
        for batch in batches:
            where = batch.column(2).to_pylist()
            out = [[], [], [], []]
            for row, end, data, bounds in bytesx.slices(batch.column(1)):
                starts, _, first, text = sentences(data, bounds, few_words is not None)
                limits = np.searchsorted(text, np.arange(end - row + 1))
                for i in range(end - row):
                    lo, hi = limits[i], limits[i + 1]
                    gone = np.zeros(hi - lo, bool)
                    for p in where[row + i] or ():
                        gone[p // (span + 1) : p // (span + 1) + p % (span + 1)] = True
                    whole = data[bounds[i] : bounds[i + 1]].tobytes()
                    if gone.any():
                        cut = np.append(starts[first[lo:hi]] - bounds[i], len(whole))
                        kept = whole[: cut[0]] + b"".join(whole[a:b] for a, b, g in zip(cut[:-1], cut[1:], gone) if not g)
                    else:
                        kept = whole
                    for column, v in zip(out, (int(hi - lo), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode())):
                        column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=["doc_id", "n_sentences", "n_removed", "kept_sha256", "kept"])

    met = docs.join(covered, ["doc_id", "th"], "left").select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), "text", "places")
    return met.mapInArrow(run, "doc_id long, n_sentences long, n_removed long, kept_sha256 string, kept string")
