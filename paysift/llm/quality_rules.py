"""Quality rules: base statistics of a text and the lines that a host repeats.

Each document sends the hashes of its distinct normalised lines (case of A-Z and
white space don't count) with its host and the hash of all its lines. A line's
frequency is the number of distinct documents of the host that hold it; copies,
documents of equal lines, are one document. Lines above both limits, a number of
documents and a share of the host's documents, are removed; a document that
keeps too few of its words is rejected as depleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm import bytesx
from paysift.llm.store import table

MIN_WORDS = 50
#: Most words, in percent, that may stand in repeated 3-word windows.
MAX_REPEATED = 50
#: A line is removed if more documents of its host hold it than both of these: a count, and this percentage of the host's documents.
LIMIT_DOCS, LIMIT_PERCENT = 20, 1
#: Least words, in percent, that a document must keep.
MIN_KEPT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LEADS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point

_SCHEMA = (
    "doc_id long, host string, whole long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<struct<h:long,line:int,words:int>>"
)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of ``flags`` are set in each text."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an equal before it, has an equal anywhere) for each key."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return later, any_


def _salted(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    return bytesx.mix(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _statistics(data: np.ndarray, bounds: np.ndarray) -> dict:
    """The base statistics of each text, and the lines with a word: text, hash, number in the text, words."""
    starts, ends, firsts = bytesx.word_spans(data, bounds, bytesx.SPACE)
    n_words = np.diff(firsts)
    out = {
        "n_words": n_words,
        "word_chars": _per_text(_LEADS[data] & ~bytesx.SPACE[data], bounds),
        "n_symbols": _per_text(_SYMBOL[data], bounds),
    }
    exact = bytesx.running_hash(bytesx.BYTE_VALUE[data])
    text = np.repeat(np.arange(len(n_words)), n_words)

    words = bytesx.running_hash(bytesx.span_hash(exact, starts, ends))
    at = np.flatnonzero(text[:-2] == text[2:]) if len(text) > 2 else np.zeros(0, np.int64)
    again = at[_repeats(_salted(bytesx.span_hash(words, at, at + 3), text[at]))[1]]
    inside = np.zeros(len(text), bool)
    for i in range(3):
        inside[again + i] = True
    out["n_repeat_words"] = _per_text(inside, firsts)

    # the lines that hold a word: from one line feed or text start to the next
    breaks = np.flatnonzero(data == 10)
    opens = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    opens = opens[opens < len(data)]
    line = np.searchsorted(opens, starts, "right") - 1
    first = np.flatnonzero(np.diff(line, prepend=-1))  # first word of each line with a word
    last = np.append(first[1:], len(starts))
    opens, of_text = opens[line[first]], text[first]
    after = np.searchsorted(breaks, opens)
    closes = np.where(after < len(breaks), breaks[np.minimum(after, len(breaks) - 1)] if len(breaks) else 0, len(data))
    closes = np.minimum(closes, bounds[of_text + 1])
    later = _repeats(_salted(bytesx.span_hash(exact, opens, closes), of_text))[0]
    of_line = np.searchsorted(of_text, np.arange(len(n_words) + 1))
    out["n_dup_lines"] = _per_text(later, of_line)

    lower = bytesx.running_hash(bytesx.span_hash(bytesx.running_hash(bytesx.LOWER_VALUE[data]), starts, ends))
    lines = bytesx.span_hash(lower, first, last)
    number = np.searchsorted(breaks, opens, "right") - np.searchsorted(breaks, bounds[of_text])
    whole = bytesx.span_hash(bytesx.running_hash(lines), of_line[:-1], of_line[1:])
    return out | {"whole": whole.view(np.int64), "of_line": of_line, "h": lines.view(np.int64), "line": number, "words": last - first}


def _read(docs: DataFrame, host: str) -> DataFrame:
    """One row per document: base statistics, the hash of all its lines, and its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, bounds in bytesx.slices(batch.column(2)):
                s = _statistics(data, bounds)
                fields = [pa.array(s["h"]), pa.array(s["line"].astype(np.int32)), pa.array(s["words"].astype(np.int32))]
                lines = pa.ListArray.from_arrays(pa.array(s["of_line"].astype(np.int32)), pa.StructArray.from_arrays(fields, names=["h", "line", "words"]))
                counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                columns = [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row), pa.array(s["whole"]), *(pa.array(s[c].astype(np.int64)) for c in counts), lines]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "whole", *counts, "lines"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def frequent_lines(lines: DataFrame, limit_docs: int = LIMIT_DOCS, limit_percent: float = LIMIT_PERCENT) -> DataFrame:
    """(host, h, n_docs) of the lines that more documents of their host hold than both limits allow.

    ``lines`` has (host, whole, h), repeats allowed. Spark counts distinct documents
    in two steps, by line and document and then by line, so a line that a third of all
    documents hold is counted by many tasks.
    """
    held = lines.groupBy("host", "h").agg(F.count_distinct("whole").alias("n_docs")).where(F.col("n_docs") > limit_docs)
    hosts = lines.groupBy("host").agg(F.count_distinct("whole").alias("host_docs"))
    above = held.join(hosts, "host").where(F.col("n_docs") * 100 > F.col("host_docs") * limit_percent)
    return above.select("host", "h", "n_docs")


def apply_rules(
    docs: DataFrame,
    host: str = "source",
    limit_docs: int = LIMIT_DOCS,
    limit_percent: float = LIMIT_PERCENT,
    min_words: int = MIN_WORDS,
    max_repeated: float = MAX_REPEATED,
    min_kept: float = MIN_KEPT,
) -> DataFrame:
    """A verdict for every row of ``docs`` (doc_id, text, ``host``, any others).

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, removed_lines, n_removed_words, kept). ``removed_lines`` numbers
    the removed lines of the text, split at line feeds, from 0. ``kept`` is
    false if the base rules fail or under ``min_kept`` percent of the words
    remain. A null or blank text has no words and fails the base rules; a null
    host is the host ''. Repeated rows each get a verdict, and count once for
    their lines; a null doc_id stays null. An empty table gives no rows.
    """
    rows = table(_read(docs, host).withColumn("place", F.monotonically_increasing_id()))
    lines = rows.select("place", "host", "whole", F.explode("lines").alias("l")).select("place", "host", "whole", "l.*")
    gone = lines.join(frequent_lines(lines, limit_docs, limit_percent), ["host", "h"], "left_semi")
    gone = gone.groupBy("place").agg(F.array_sort(F.collect_list("line")).alias("removed_lines"), F.sum("words").alias("gone"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated)
    removed = F.coalesce("gone", F.lit(0)).cast("long")
    kept = ~failed & ((F.col("n_words") - removed) * 100 >= F.col("n_words") * min_kept)
    return rows.drop("lines").join(gone, "place", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"), removed.alias("n_removed_words"), kept.alias("kept"),
    )


def without_lines(text, removed_lines):
    """The text without the lines whose numbers :func:`apply_rules` gives."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(removed_lines, i)), "\n")
