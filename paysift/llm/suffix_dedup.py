"""Exact substring deduplication over sorted suffixes.

Removes every byte that is covered by a WINDOW-byte string that starts at
another place of the corpus as well (same document included). Matches never
cross documents; strings are judged on the input.

A full suffix array over a corpus does not fit a cluster's shuffle, so only
anchored suffixes are sorted. The anchor of a window is its GRAM-byte substring
with the smallest hash (the leftmost, if tied): equal windows have their anchor
at the same offset, and an anchor serves a run of neighbouring windows, whose
union is its context. Then:

1. Anchors whose gram occurs once in the corpus have no repeated window. They
   go, after a count per gram that is summed before the shuffle.
2. Contexts that occur more than once as a whole are repeated as a whole.
3. The other contexts of a repeated gram differ somewhere: the edges of repeated
   passages. A task sorts the suffixes that follow the gram, and the reversed
   prefixes before it, by deep-shallow sorting: multikey quicksort on eight bytes
   at a time to a shallow depth, then a blind trie for each group that is still
   equal. A window with l bytes before the gram equals another exactly if both
   are in one class of the prefixes cut at l bytes and one class of the suffixes
   cut at the rest; neighbours' common lengths give these classes for every l.
   A gram with more than MAX_GROUP distinct contexts is not given to one task:
   its windows are counted by digest instead, summed before the shuffle.
4. Covered spans meet their document, and the rest is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm import bytesx
from paysift.llm.store import drop, table

WINDOW = 200
GRAM = 50
SIDE = WINDOW - GRAM  # bytes of a window beside its gram
SHALLOW_WORDS = 3
MAX_GROUP = 50_000
TASK_ROWS = 8_192
#: A longer text is read in pieces of this size.
PIECE = 4 << 20
_POSITION = np.uint64((1 << 23) - 1)


def anchors(data: np.ndarray, bounds: np.ndarray):
    """(text, first, last, anchor) of every run of windows with one anchor, as
    offsets in ``data``; also the running hash of ``data``."""
    running = bytesx.running_hash(bytesx.BYTE_VALUE[data])
    n = len(data) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return (none, none, none, none), running
    at = np.arange(len(data) - GRAM + 1)
    key = bytesx.span_hash(running, at, at + GRAM)
    key = (key & ~_POSITION) | at.astype(np.uint64)
    width = 1
    while 2 * width <= SIDE + 1:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if (rest := SIDE + 1 - width) > 0:
        key = np.minimum(key[:-rest], key[rest:])
    anchor = (key & _POSITION).astype(np.int64)
    starts = np.arange(n)
    text = np.searchsorted(bounds, starts, "right") - 1
    ok = starts + WINDOW <= bounds[text + 1]
    starts, text, anchor = starts[ok], text[ok], anchor[ok]
    if not len(starts):
        return (none, none, none, none), running
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(text) != 0)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new - 1, [len(starts) - 1]])
    return (text[first], starts[first], starts[last], anchor[first]), running


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(row, bytes, bounds, offset in the text): slices of whole texts, long texts in overlapping pieces."""
    for row, _, data, bounds in bytesx.slices(column, min(PIECE, bytesx.SLICE_BYTES)):
        if len(data) <= PIECE:
            yield row, data, bounds, 0
            continue
        for i in range(0, len(data) - WINDOW + 1, PIECE - WINDOW + 1):  # a slice this long is one text
            part = data[i : i + PIECE]
            yield row, part, np.array([0, len(part)]), i


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(gram, context, doc_id, th, first, before, after) of every anchor: the
    context starts at byte ``first`` of the document and has ``before`` bytes,
    the gram, and ``after`` bytes."""

    def run(batches):
        for batch in batches:
            ids, ths = batch.column(0), batch.column(1)
            for row, data, bounds, offset in _pieces(batch.column(2)):
                (text, first, last, anchor), running = anchors(data, bounds)
                if not len(text):
                    continue
                gram = bytesx.span_hash(running, anchor, anchor + GRAM)
                before, after = anchor - first, last + WINDOW - anchor - GRAM
                context = bytesx.mix(bytesx.span_hash(running, first, last + WINDOW) + before.astype(np.uint64))
                rows = pa.array(text + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), ids.take(rows), ths.take(rows),
                     pa.array(first - bounds[text] + offset), pa.array(before.astype(np.int16)), pa.array(after.astype(np.int16))],
                    names=["gram", "context", "doc_id", "th", "first", "before", "after"],
                )

    return docs.mapInArrow(run, "gram long, context long, doc_id long, th long, first long, before short, after short")


class BlindTrie:
    """Sorts distinct equally long strings, looking at whole strings only to check a blind descent."""

    def __init__(self):
        self.root = None

    def insert(self, s: bytes) -> None:
        if self.root is None:
            self.root = s
            return
        node = self.root
        while not isinstance(node, bytes):  # branch bytes only
            skip, below = node
            node = below.get(s[skip]) or next(iter(below.values()))
        if node == s:
            return
        d = common_length(s, node)
        parent, key, node = None, None, self.root
        while not isinstance(node, bytes) and node[0] < d:
            parent, key = node, s[node[0]]
            node = node[1][key]
        if not isinstance(node, bytes) and node[0] == d:
            node[1][s[d]] = s
            return
        some = node
        while not isinstance(some, bytes):
            some = next(iter(some[1].values()))
        branch = (d, {some[d]: node, s[d]: s})
        if parent is None:
            self.root = branch
        else:
            parent[1][key] = branch

    def __iter__(self) -> Iterator[bytes]:
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                yield node
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two different equally long strings."""
    lo, hi = 0, len(a)
    while lo + 1 < hi:  # a[:lo] == b[:lo], a[:hi] != b[:hi]
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def deep_shallow(group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The order of rows of ``strings`` (uint8 matrix) by group, then bytes."""
    m, width = strings.shape
    padded = np.zeros((m, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8")
    order = np.argsort(group, kind="stable")
    same = np.concatenate([[0], np.cumsum(np.diff(group[order]) != 0)])
    for k in range(SHALLOW_WORDS):  # multikey quicksort: one word at a time within the classes so far
        by = np.lexsort((words[order, k], same))
        order, same = order[by], same[by]
        w = words[order, k]
        same = np.concatenate([[0], np.cumsum((np.diff(same) != 0) | (w[1:] != w[:-1]))])
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(same)) + 1, [m]])
    for i, j in zip(cuts[:-1], cuts[1:]):
        if j - i > 1:
            rows: dict[bytes, list[int]] = {}
            for r in order[i:j]:
                rows.setdefault(strings[r].tobytes(), []).append(r)
            trie = BlindTrie()
            for s in rows:
                trie.insert(s)
            order[i:j] = [r for s in trie for r in rows[s]]
    return order


def _side(parts: list[bytes], group: np.ndarray):
    """Sort the strings of one side of the grams: (place of each row, common lengths of neighbours)."""
    m = len(parts)
    lengths = np.fromiter(map(len, parts), np.int64, m)
    strings = np.zeros((m, SIDE + 1), np.uint8)
    flat = np.frombuffer(b"".join(parts), np.uint8)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    strings[np.repeat(np.arange(m), lengths), column] = flat
    strings[:, SIDE] = lengths  # shorter first among equally padded
    order = deep_shallow(group, strings)
    common = np.full(m, -1, np.int64)  # with the row before in order; -1: another gram
    a, b = strings[order[:-1], :SIDE], strings[order[1:], :SIDE]
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE)
    first = np.minimum(first, np.minimum(lengths[order[:-1]], lengths[order[1:]]))
    common[1:] = np.where(group[order[:-1]] == group[order[1:]], first, -1)
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    return place, common, lengths


def repeated_windows(group: np.ndarray, before: list[bytes], after: list[bytes]) -> np.ndarray:
    """found[i, l]: the window of row i with l bytes before the gram is also in another row.

    ``before`` and ``after`` are the bytes around each row's gram, ``group`` its gram.
    """
    left = _side([b[::-1] for b in before], group)
    right = _side(after, group)
    m = len(group)
    found = np.zeros((m, SIDE + 1), bool)
    for l in range(SIDE + 1):  # noqa: E741
        rows = np.flatnonzero((left[2] >= l) & (right[2] >= SIDE - l))
        if len(rows) < 2:
            continue
        a = np.cumsum(left[1] < l)[left[0][rows]]
        b = np.cumsum(right[1] < SIDE - l)[right[0][rows]]
        code = a * (m + 1) + b
        by = np.argsort(code, kind="stable")
        same = code[by][1:] == code[by][:-1]
        twice = np.zeros(len(rows), bool)
        twice[by[1:]] |= same
        twice[by[:-1]] |= same
        found[rows, l] = twice
    return found


def _edge_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, th, start, end) of the repeated windows of rows (gram, doc_id, th, first, before, after, bytes)."""

    def run(batches):
        rest = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = got if rest is None else pa.concat_tables([rest, got])
            if rest.num_rows >= TASK_ROWS:
                gram = rest.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
                if cut:
                    yield spans(rest.slice(0, cut).combine_chunks())
                    rest = rest.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield spans(rest.combine_chunks())

    def spans(t):
        group, first, n_before = (t.column(c).to_numpy().astype(np.int64) for c in ("gram", "first", "before"))
        text = t.column("bytes").to_pylist()
        before = [x[:k] for x, k in zip(text, n_before)]
        after = [x[k + GRAM :] for x, k in zip(text, n_before)]
        return _runs(repeated_windows(group, before, after), t, first, n_before)

    columns = ["gram", "doc_id", "th", "first", "before", "bytes"]
    return rows.select(*columns).repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "doc_id long, th long, start long, end long")


def _runs(found: np.ndarray, t, first: np.ndarray, n_before: np.ndarray) -> pa.RecordBatch:
    edge = np.zeros((len(found), found.shape[1] + 2), np.int8)
    edge[:, 1:-1] = found
    step = np.diff(edge, axis=1)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    at = first[row] + n_before[row]
    where = pa.array(row)
    column = lambda c: t.column(c).combine_chunks().take(where)
    return pa.RecordBatch.from_arrays(
        [_one(column("doc_id")), _one(column("th")), pa.array(at - high + 1), pa.array(at - low + WINDOW)], names=["doc_id", "th", "start", "end"]
    )


def _one(a):
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def _hot_spans(rows: DataFrame) -> DataFrame:
    """The same for grams with very many contexts: windows counted by digest."""

    def run(batches):
        for batch in batches:
            cols = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            out = []
            for i, (gram, first, before, text) in enumerate(zip(*(cols[c].to_pylist() for c in ("gram", "first", "before", "bytes")))):
                running = bytesx.running_hash(bytesx.BYTE_VALUE[np.frombuffer(text, np.uint8)])
                start = np.arange(len(text) - WINDOW + 1)
                h = bytesx.mix(bytesx.span_hash(running, start, start + WINDOW) + np.uint64(gram & (1 << 64) - 1) + (before - start).astype(np.uint64))
                out.append((np.full(len(start), i), h, first + start))
            row, h, start = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            where = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), cols["doc_id"].take(where), cols["th"].take(where), pa.array(start)], names=["h", "doc_id", "th", "start"])

    windows = rows.select("gram", "doc_id", "th", "first", "before", "bytes").mapInArrow(run, "h long, doc_id long, th long, start long")
    twice = windows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    return windows.join(twice, "h").select("doc_id", "th", "start", (F.col("start") + WINDOW).alias("end"))


def _with_bytes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (gram, hot, doc_id, th, first, before, after) with the bytes of their contexts."""
    wanted = rows.groupBy("doc_id", "th").agg(F.collect_list(F.struct("gram", "hot", "first", "before", "after")).alias("w"))

    def run(batches):
        for batch in batches:
            w = batch.column(3)
            parent = np.repeat(np.arange(len(w)), np.diff(w.offsets.to_numpy()))
            flat = w.flatten()
            children = flat.flatten()
            field = {f.name: children[i] for i, f in enumerate(flat.type)}
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            first = field["first"].to_numpy()
            size = field["before"].to_numpy().astype(np.int64) + GRAM + field["after"].to_numpy()
            for i in range(0, len(parent), TASK_ROWS):
                j = slice(i, i + TASK_ROWS)
                where = pa.array(parent[j])
                cut = [texts[p][a : a + n] for p, a, n in zip(parent[j], first[j], size[j])]
                yield pa.RecordBatch.from_arrays(
                    [field["gram"][j], field["hot"][j], batch.column(0).take(where), batch.column(1).take(where), field["first"][j], field["before"][j], pa.array(cut, pa.binary())],
                    names=["gram", "hot", "doc_id", "th", "first", "before", "bytes"],
                )

    met = docs.join(wanted, ["doc_id", "th"]).select("doc_id", "th", "text", "w")
    return met.mapInArrow(run, "gram long, hot boolean, doc_id long, th long, first long, before short, bytes binary")


def repeated_spans(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, th, start, end): byte spans of ``docs`` (doc_id, th, text) whose windows are all repeated; they may overlap."""
    every = table(_anchor_rows(docs))
    grams = every.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    rows = table(every.join(grams, "gram"))
    drop(every)
    contexts = rows.groupBy("gram", "context").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "first", "before", "after")).alias("one"))
    contexts = table(contexts)
    whole = rows.join(contexts.where("c > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    whole = whole.select("doc_id", "th", F.col("first").alias("start"), (F.col("first") + F.col("before") + GRAM + F.col("after")).alias("end"))
    # contexts that occur once are compared with one copy of each other context of their gram
    per_gram = contexts.groupBy("gram").agg(F.count("*").alias("n"), F.min("c").alias("least")).where("n > 1 and least = 1")
    edges = contexts.join(per_gram.select("gram", (F.col("n") > max_group).alias("hot")), "gram").select("gram", "hot", "one.*")
    edges = table(_with_bytes(docs, edges))
    return whole.unionByName(_edge_spans(edges.where("not hot"))).unionByName(_hot_spans(edges.where("hot")))


def remove_repeats(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) for every row of ``docs`` (doc_id, text, any others).

    ``kept`` is the rest of the text in UTF-8 (binary: a cut may fall inside a
    character), ``spans`` the maximal removed runs as byte offsets. A null text
    is empty. Rows that repeat another, with a null doc_id or not, are texts
    at places of their own, so long ones are removed whole. An empty table
    gives no rows.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    spans = repeated_spans(docs, max_group).groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("s"))

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for text, s in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                runs = []
                for x in sorted((x["start"], x["end"]) for x in s or ()):
                    if runs and x[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], x[1])
                    else:
                        runs.append(list(x))
                ends = [0, *(e for _, e in runs)]
                kept = b"".join(text[e:b] for e, b in zip(ends, [*(b for b, _ in runs), len(text)]))
                for column, v in zip(out, (len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, [{"start": a, "end": b} for a, b in runs])):
                    column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    met = docs.join(spans, ["doc_id", "th"], "left").select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), "text", "s")
    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, end: long>>")
