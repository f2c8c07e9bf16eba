"""Grouping of spelling variants: words that one edit turns into each other.

A word is a point: how often each letter stands in its first half, and in its
second (accented letters share a few coordinates). A replaced letter changes the
counts of one half, by two in sum. A word with one letter less, cut in two
before or after the place of the cut, has the same counts as the longer one but for that
letter. So near words are found by range searches in k-d trees over the count
vectors, per pair of lengths: (n, n) within L1 distance two, and (n - 1, n)
within one, once for either way to cut the shorter word. A box farther away
than that has none of them. Points within range are verified letter by letter.

The upper part of each length's tree is made on the driver from a bounded sample
and cuts space into cells. Every word is a point of one cell, and a query of each
cell whose box is in range. A task joins one cell's points and queries by k-d
trees of their own: boxes of queries against boxes of points, then the members of
the pairs in range. Cells of more points or queries than a task may hold are cut
into pieces that meet piece by piece. Only counts and the best partner of
each word leave a task, so no pairs are written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysift.llm.sampling import in_share
from paysift.llm.store import table

MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
#: Words that the upper trees are fitted to, as expected from a hash sample, and the words that a cell is meant to hold.
SAMPLE_WORDS, CELL_WORDS = 50_000, 40_000
#: Letters of the points, and of the queries, that one task holds.
PIECE_LETTERS = 1 << 19
LEAF = 12
#: Pairs of boxes, or of one box's points with another's, that are measured at a time.
STEP = 1 << 16
#: Coordinates: a-z, and the other code points by remainder. Counts are told apart up to LEVELS; the fewer, the looser the bound.
DIMS, LEVELS = 32, 2
#: What a word is to a cell: a point, or a query for words as long or one letter longer.
POINT, SAME, EARLY, LATE = range(4)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, where each word starts and the end)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def count_codes(words: list[str], split: int) -> np.ndarray:
    """Letter counts of each word before the letter ``split`` and from there on, as bits.

    A count c sets the first c of its LEVELS bits (a larger one sets all), so the
    number of bits in which two codes differ is their L1 distance, or less where counts are
    cut off. The minimum of some points is the AND of their codes, the maximum the OR.
    """
    codes, bounds = _letters(words)
    sizes = np.diff(bounds)
    word = np.repeat(np.arange(len(words)), sizes)
    dim = np.where((codes >= 97) & (codes < 123), codes - 97, 26 + codes % (DIMS - 26)).astype(np.int64)
    late = np.arange(len(codes)) - bounds[:-1][word] >= split
    counts = np.bincount(word * (2 * DIMS) + dim + DIMS * late, minlength=len(words) * 2 * DIMS)
    bits = counts.reshape(len(words), 2 * DIMS, 1) > np.arange(LEVELS)
    return np.packbits(bits.reshape(len(words), -1), axis=1, bitorder="little").view(np.uint64)


def _differ(bits: np.ndarray) -> np.ndarray:
    """How many bits are set in each row."""
    return np.bitwise_count(bits).sum(axis=1, dtype=np.uint8)


def _in_range(low: np.ndarray, high: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """True for the queries within ``radius`` of the box [low, high]."""
    return _differ((low & ~queries) | (queries & ~high)) <= radius  # no bit is in both


def _bits(codes: np.ndarray) -> np.ndarray:
    return np.unpackbits(codes.view(np.uint8).reshape(len(codes), -1), axis=1, bitorder="little")


def _cut(bits: np.ndarray) -> int | None:
    """The bit, a letter and a count, that parts the points most evenly: those with fewer of the letter, and the others; None if all agree."""
    have = np.add.reduce(bits, axis=0, dtype=np.int64)
    best = int(np.argmin(np.abs(2 * have - len(bits))))
    return best if 0 < have[best] < len(bits) else None


def _one_bit(bit: int) -> np.ndarray:
    out = np.zeros(2 * DIMS * LEVELS, np.uint8)
    out[bit] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


@dataclass
class _Node:
    """A box of an upper tree: cut at ``bit``, or the cell ``cell``."""

    cell: int = -1
    bit: int = 0
    fewer: _Node | None = None
    more: _Node | None = None


@dataclass
class UpperTrees:
    """One tree for each length that the sample has; words of other lengths are one cell."""

    trees: dict[int, _Node] = field(default_factory=dict)

    @classmethod
    def fit(cls, words: list[str], cell_words: float) -> UpperTrees:
        """Trees whose cells hold about ``cell_words`` words of the sample."""
        out = cls()
        by_length: dict[int, list[str]] = {}
        for w in sorted(words):
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            bits = _bits(count_codes(group, n // 2))
            out.trees[n] = cls._split(bits, max(cell_words, 8), iter(range(len(group) + 1)))
        return out

    @staticmethod
    def _split(bits: np.ndarray, cell_words: float, cells: Iterator[int]) -> _Node:
        if len(bits) > cell_words and (bit := _cut(bits)) is not None:
            more = bits[:, bit] == 1
            return _Node(-1, bit, UpperTrees._split(bits[~more], cell_words, cells), UpperTrees._split(bits[more], cell_words, cells))
        return _Node(next(cells))

    def cells(self, n: int, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell): the cells of length ``n`` whose boxes are in range of each code; radius 0 for points."""
        if n not in self.trees:
            return np.arange(len(codes)), np.zeros(len(codes), np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def walk(node: _Node, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            rows = rows[_in_range(low, high, codes[rows], radius)]
            if not len(rows):
                return
            if node.cell >= 0:
                found.append((rows, np.full(len(rows), node.cell, np.int32)))
                return
            bit = _one_bit(node.bit)
            walk(node.fewer, rows, low, high & ~bit)
            walk(node.more, rows, low | bit, high)

        words = 2 * DIMS * LEVELS // 64
        walk(self.trees[n], np.arange(len(codes)), np.zeros(words, np.uint64), np.full(words, ~np.uint64(0)))
        return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def _matrix(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True for rows of letters that one edit turns into each other; b's rows are as long or one letter longer."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


class _Tree:
    """A k-d tree over codes, as arrays: each node's box, size, children (-1: a leaf) and members.

    All nodes of a level are cut at once. Points that agree in all coordinates
    are cut by number, so no leaf has more than LEAF.
    """

    def __init__(self, codes: np.ndarray):
        bits = _bits(codes)
        levels, members = [], []
        rows, first, nodes, leaves = np.arange(len(codes)), np.zeros(1, np.int64), 0, 0
        while len(first):
            size = np.diff(np.append(first, len(rows)))
            here = codes[rows]
            wide = size > LEAF
            left = np.full(len(size), -1)
            left[wide] = nodes + len(size) + 2 * np.arange(wide.sum())
            leaf_of = np.full(len(size), -1)
            leaf_of[~wide] = leaves + np.arange((~wide).sum())
            levels.append((np.bitwise_and.reduceat(here, first, axis=0), np.bitwise_or.reduceat(here, first, axis=0), size, left, leaf_of))
            node = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(rows)) - first[node]
            done = ~wide[node]
            some = np.full(((~wide).sum(), LEAF), -1)
            some[leaf_of[node[done]] - leaves, place[done]] = rows[done]
            members.append(some)
            nodes, leaves = nodes + len(size), leaves + len(some)
            rows, place, size = rows[~done], place[~done], size[wide]
            if not len(rows):
                break
            node = np.repeat(np.arange(len(size)), size)
            some = bits[rows]
            have = np.add.reduceat(some, np.cumsum(size) - size, axis=0, dtype=np.int32)
            best = np.argmin(np.abs(2 * have - size[:, None]), axis=1)
            most = have[np.arange(len(size)), best]
            more = np.where(((most > 0) & (most < size))[node], some[np.arange(len(rows)), best[node]], place % 2)
            child = 2 * node + more
            rows = rows[np.argsort(child, kind="stable")]
            counts = np.bincount(child, minlength=2 * len(size))
            first = np.cumsum(counts) - counts
        self.low, self.high, self.size, self.left, self.leaf_of = (np.concatenate(x) for x in zip(*levels))
        self.right = np.where(self.left < 0, -1, self.left + 1)
        self.members = np.concatenate(members)


def _box_pairs(points: _Tree, queries: _Tree, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves (of queries, of points) whose boxes are in range of each other."""
    todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        q, p = todo.pop()
        near = _differ((points.low[p] & ~queries.high[q]) | (queries.low[q] & ~points.high[p])) <= radius
        q, p = q[near], p[near]
        q_leaf, p_leaf = queries.leaf_of[q], points.leaf_of[p]
        ends = (q_leaf >= 0) & (p_leaf >= 0)
        if ends.any():
            yield q_leaf[ends], p_leaf[ends]
        q, p, q_leaf, p_leaf = q[~ends], p[~ends], q_leaf[~ends], p_leaf[~ends]
        by_point = (q_leaf >= 0) | ((p_leaf < 0) & (points.size[p] >= queries.size[q]))
        deeper_q = np.concatenate([q[by_point], q[by_point], queries.left[q[~by_point]], queries.right[q[~by_point]]])
        deeper_p = np.concatenate([points.left[p[by_point]], points.right[p[by_point]], p[~by_point], p[~by_point]])
        todo += [(deeper_q[i : i + STEP], deeper_p[i : i + STEP]) for i in range(0, len(deeper_q), STEP)]


class Cell:
    """Points of ``n`` letters, ready to be searched."""

    def __init__(self, points: list[str], n: int):
        self.n = n
        self.letters, self.codes = _matrix(points, n), count_codes(points, n // 2)
        self.tree, self.columns = _Tree(self.codes), self.codes.T.copy()

    def _in_reach(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, point) of codes within ``radius``: all queries are searched at once, by a tree of their own."""
        tree, columns = _Tree(queries), queries.T.copy()
        step = max(1, STEP // LEAF**2)
        for q_leaf, p_leaf in _box_pairs(self.tree, tree, radius):
            for i in range(0, len(q_leaf), step):
                q, p = tree.members[q_leaf[i : i + step]], self.tree.members[p_leaf[i : i + step]]
                off = np.bitwise_count(columns[0][q][:, :, None] ^ self.columns[0][p][:, None, :])
                off += np.bitwise_count(columns[1][q][:, :, None] ^ self.columns[1][p][:, None, :])
                hit = np.flatnonzero(off.ravel() <= radius)
                a, b = q.ravel()[hit // LEAF], p[hit // LEAF**2, hit % LEAF]
                some = (a >= 0) & (b >= 0)
                yield a[some], b[some]

    def near(self, queries: list[str], role: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, point) that differ by one edit. Queries have as many letters (SAME), or one
        less and are cut before (EARLY) or after (LATE) the place where the points are. LATE leaves
        out the pairs that EARLY finds."""
        if not queries:
            return
        n, texts = self.n, _matrix(queries, self.n - (role != SAME))
        early = count_codes(queries, n // 2 - 1) if role == LATE else None
        step = max(1, (1 << 22) // max(n, 1))
        for q, p in self._in_reach(count_codes(queries, n // 2 - (role == EARLY)), 2 if role == SAME else 1):
            if early is not None:
                new = _differ(early[q] ^ self.codes[p]) > 1
                q, p = q[new], p[new]
            for i in range(0, len(q), step):
                a, b = q[i : i + step], p[i : i + step]
                near = _one_edit(texts[a], self.letters[b])
                yield a[near], b[near]


_BEST = "word string, n_near long, best_n long, best string"
_BEST_NAMES = ["word", "n_near", "best_n", "best"]


def _best(words: list[str], a: np.ndarray, b: np.ndarray, other_words: list[str], other_n: np.ndarray) -> pa.RecordBatch:
    """For each word a with near words b: how many, and the one of largest n (ties: the smallest)."""
    rank = np.empty(len(other_words), np.int64)
    rank[sorted(range(len(other_words)), key=other_words.__getitem__)] = np.arange(len(other_words))
    order = np.lexsort((rank[b], -other_n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    counts = np.diff(np.append(first, len(a)))
    columns = [pa.array([words[i] for i in a[first]], pa.string()), pa.array(counts), pa.array(other_n[b[first]], pa.int64()), pa.array([other_words[i] for i in b[first]], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=_BEST_NAMES)


def _join_cell(group: pa.Table) -> pa.Table:
    """Near words within one piece of a cell: its points and the queries of both lengths."""
    word, n, size = (group[c].to_pylist() for c in ("word", "n", "size"))
    role = group["role"].to_numpy()
    out = [pa.RecordBatch.from_pylist([], pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))]
    of_point = np.flatnonzero(role == POINT)
    points, n_points = [word[i] for i in of_point], np.array([n[i] for i in of_point], np.int64)
    cell = Cell(points, size[of_point[0]]) if points else None
    for kind in (SAME, EARLY, LATE):
        of_query = np.flatnonzero(role == kind)
        queries, n_queries = [word[i] for i in of_query], np.array([n[i] for i in of_query], np.int64)
        found = list(cell.near(queries, kind)) if cell else []
        if found:
            q, p = (np.concatenate([x[i] for x in found]) for i in (0, 1))
            out.append(_best(queries, q, p, points, n_points))
            if kind != SAME:  # words of different lengths meet once: the longer one is told as well
                out.append(_best(points, p, q, queries, n_queries))
    return pa.Table.from_batches(out)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for each of the distinct ``words`` (word, n) with
    any near word: their number, and the one of largest n (ties: smallest in code-point order)."""
    total = words.count()
    sample = words.where(in_share("word", share=SAMPLE_WORDS / max(total, 1))).select("word")
    sample = [r.word for r in sample.collect()]  # SAMPLE_WORDS of them, as expected
    trees = UpperTrees.fit(sample, CELL_WORDS * len(sample) / max(total, 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column(0).to_pylist()
            sizes = np.array([len(w) for w in word], np.int64)
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                mine = [word[i] for i in rows]
                at, longer = int(n) // 2, (int(n) + 1) // 2
                for role, length, split, radius in ((POINT, n, at, 0), (SAME, n, at, 2), (EARLY, n + 1, longer - 1, 1), (LATE, n + 1, longer, 1)):
                    codes = count_codes(mine, split)
                    row, cell = trees.cells(int(length), codes, radius)
                    take = pa.array(rows[row])
                    k = len(row)
                    columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(k, role, np.int32)), pa.array(np.full(k, length, np.int32)), pa.array(cell, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "role", "size", "cell"])

    dealt = table(words.select("word", "n").mapInArrow(deal, "word string, n long, role int, size int, cell int"))
    point = F.col("role") == POINT
    letters = F.col("size").cast("long") + 1
    pieces = dealt.groupBy("size", "cell").agg(
        F.ceil(F.coalesce(F.sum(F.when(point, letters)), F.lit(0)) / PIECE_LETTERS).alias("points"),
        F.ceil(F.coalesce(F.sum(F.when(~point, letters)), F.lit(0)) / PIECE_LETTERS).alias("queries"),
    ).where("points > 0 and queries > 0")
    # a point goes to one piece of the points, and there to each piece of the queries; a query the other way round
    own = F.pmod(F.xxhash64("word"), F.when(point, F.col("points")).otherwise(F.col("queries")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.when(point, F.col("queries")).otherwise(F.col("points")) - 1))
    met = dealt.join(pieces, ["size", "cell"]).select("word", "n", "role", "size", "cell", own.alias("own"), each.alias("other"))
    met = met.select("word", "n", "role", "size", "cell", F.when(point, F.col("own")).otherwise(F.col("other")).alias("p"), F.when(point, F.col("other")).otherwise(F.col("own")).alias("q"))
    found = met.groupBy("size", "cell", "p", "q").applyInArrow(_join_cell, _BEST)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("one"))
    return found.select("word", "n_near", (-F.col("one.less")).alias("best_n"), F.col("one.word").alias("best"))


def group_spellings(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of the distinct ``words`` (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point. A
    word's form is its near word of largest n (ties: smallest in code-point
    order), if that n is at least ``ratio`` times the word's, else null. Its root
    is what following the forms leads to; a word without a form is its own. Null
    words are left out; an empty word is near to words of one letter. An empty
    table gives no rows.
    """
    words = table(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")))
    found = near_words(words)
    follows = F.col("best_n") >= F.col("n") * ratio
    out = table(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(follows, F.col("best")).alias("form"), F.when(follows, F.col("best_n")).alias("form_n")
        )
    )
    # each round follows twice as many forms; n grows tenfold by each, so a few rounds end it
    roots = table(out.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("word").alias("via"), F.col("root").alias("further"))
        step = roots.join(on, F.col("root") == F.col("via"), "left")
        roots = table(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if roots.where("moved").isEmpty():
            break
        roots = roots.select("word", "root")
    return out.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def lower_az(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, spell=None) -> DataFrame:
    """(word, n): the maximal runs of letters of ``docs`` (doc_id, text, any others), A-Z in lower case, and how often they occur.

    ``spell`` maps the columns (doc_id, run) to the word that is counted; by
    default the run. Words shorter than ``min_letters`` or rarer than
    ``min_count`` are left out. A null text has no words.
    """
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{min_letters},}})"), F.lit(1)))
    rows = docs.select(F.col("doc_id").alias("id"), runs.alias("run")).select("id", lower_az(F.col("run")).alias("run"))
    word = F.col("run") if spell is None else spell(F.col("id"), F.col("run"))
    rows = rows.select(word.alias("word")).where(F.length("word") >= min_letters)
    return rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
