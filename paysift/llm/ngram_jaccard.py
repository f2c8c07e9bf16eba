"""Near-duplicate join on word shingles, bounded by a count-vector R-tree.

Each document is the set of its distinct five-word shingles; two documents
link when their Jaccard similarity is at least 0.8. The join runs in four steps.

1. *Blocks.* Any two linked sets share one of the first n - ceil(0.8 n) + 1
   shingles of each, when all sets are put in the same order. The order puts
   rare shingles first, by a frequency sketch over all documents, so passages
   that many documents share come last and rarely open a block. A block is a
   shingle with the sets that it opens; blocks of one set are dropped.
2. *Hub rounds.* In each block one set is the hub; every set that is not yet
   connected to it is verified against its best hub only. A group of thousands
   of near copies so collapses with about one pair per document.
3. *Count-vector R-tree.* For every pair that the rounds left unconnected: the
   shingles of a set are hashed into groups (64, more for larger sets), and the
   vector of group counts is a point. A packed R-tree over a block's points is joined with itself; the
   sum of the coordinate minima (of two points, or of two boxes' upper corners)
   bounds the overlap from above, and pairs that can't reach 0.8 are pruned, as
   are boxes whose sets are all connected already. A first pass tries only each
   set's most alike partner in a few of its blocks; a second one takes all
   pairs of all blocks that are still unconnected. Large blocks are cut into chunks and joined
   chunk by chunk, so no task holds a whole block.
4. *Verification.* The pairs of steps 2 and 3 that the bound leaves are counted
   exactly on the shingle sets of their whole texts.

No link is lost: steps 1 and 3 discard only what can't be a link, or joins two
sets that are in one component already.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paysift.llm import bytesx
from paysift.llm.graph import connected_components
from paysift.llm.store import checkpoint, drop, table

GROUPS = 64
SKETCH_CELLS = 1 << 20
SKETCH_PARTS = 64
CHUNK = 256
LEAF = 16
FILTER_CELLS = 1 << 20
BEST_BLOCKS = 4
#: Weights of the words of a shingle, by place.
_PLACE = bytesx.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text of ``column``."""
    for row, end, data, bounds in bytesx.slices(column):
        starts, ends, firsts = bytesx.word_spans(data, bounds, bytesx.SPACE)
        if len(starts):
            words = bytesx.span_hash(bytesx.running_hash(bytesx.LOWER_VALUE[data]), starts, ends)
            n = max(len(words) - width + 1, 0)
            runs = np.zeros(n, np.uint64)
            for k in range(width):
                runs += words[k : k + n] * _PLACE[k]
            runs = bytesx.mix(runs)
        for i in range(end - row):
            a, b = firsts[i], firsts[i + 1]
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            elif b > a:  # fewer words: the whole sequence is the one shingle
                yield bytesx.mix((words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def set_id(s: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed long: equal sets are one node."""
    return int(bytesx.mix((s * bytesx.powers(len(s))).sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0]) if len(s) else 0


def prefix_length(n: int, percent: int) -> int:
    """How many of n ordered shingles a linked set must share at least one of."""
    return n - -(-percent * n // 100) + 1


def _cells(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)


def frequency_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents hold a shingle of each hash cell, over all of ``docs``.

    Each task sends its counts once, compressed and cut into parts; the parts
    are added up by several tasks. What reaches the driver is the sum, always
    SKETCH_CELLS numbers (8 MB) however large the corpus.
    """
    step = SKETCH_CELLS // SKETCH_PARTS

    def count(batches):
        total = np.zeros(SKETCH_CELLS, np.int64)
        for batch in batches:
            for s in shingle_sets(batch.column(0), width):
                np.add.at(total, _cells(s), 1)
        parts = [(i, total[i * step : (i + 1) * step]) for i in range(SKETCH_PARTS)]
        yield _sketch_rows([(i, p) for i, p in parts if p.any()])

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(zlib.decompress(packed), np.int64)
                sums[part] = sums[part] + values if part in sums else values
        yield _sketch_rows(list(sums.items()))

    schema = "part int, packed binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition(SKETCH_PARTS, "part").mapInArrow(add_up, schema)
    out = np.zeros(SKETCH_CELLS, np.int64)
    for part, packed in parts.collect():
        out[part * step : (part + 1) * step] += np.frombuffer(zlib.decompress(bytes(packed)), np.int64)
    return out


def _sketch_rows(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in parts], pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for _, p in parts], pa.binary())],
        names=["part", "packed"],
    )


def nodes(docs: DataFrame, sketch, width: int, percent: int) -> DataFrame:
    """(doc_id, sid, n, counts, prefix) per row of ``docs`` (doc_id, text); sketch: a broadcast of :func:`frequency_sketch`."""

    def run(batches):
        # rare first: by the magnitude of the cell's count, then by the hash itself
        rank = np.frexp(sketch.value.astype(np.float64))[1].astype(np.uint64)
        for batch in batches:
            ids, sizes, counts, prefixes, lengths = [], [], [], [], []
            for s in shingle_sets(batch.column(1), width):
                keep = prefix_length(len(s), percent) if len(s) else 0
                first = s[np.lexsort((s, rank[_cells(s)]))[:keep]] if len(s) else s
                ids.append(set_id(s))
                sizes.append(len(s))
                counts.append(group_counts(s))
                prefixes.append(first.view(np.int64))
                lengths.append(len(first))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.int32())
            flat = pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.list_(pa.int8())), pa.ListArray.from_arrays(offsets, flat)],
                names=["doc_id", "sid", "n", "counts", "prefix"],
            )

    return docs.mapInArrow(run, "doc_id long, sid long, n long, counts array<byte>, prefix array<long>")


def group_counts(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each group: GROUPS groups, doubled
    while they hold more than two on average, so that the bound is sharp for
    long documents, too. A group is a run of hashes: adding neighbours gives
    the counts of half as many groups."""
    bits = GROUPS.bit_length() - 1
    while len(s) > 2 << bits:
        bits += 1
    while True:
        counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max() < 128:  # distinct hashes: more groups always end this
            return counts.astype(np.int8)
        bits += 1


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The same counts in fewer groups."""
    return counts if len(counts) == groups else counts.reshape(groups, -1).sum(axis=1, dtype=np.int32)


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by their sizes and the sum of the
    coordinate minima, with a doc_id of each. ``sets``: (sid, doc_id, n, counts)."""
    side = lambda k: sets.select(F.col("sid").alias(k), F.col("n").alias(f"n{k}"), F.col("counts").alias(f"c{k}"), F.col("doc_id").alias(f"d{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches):
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            need = percent * (col["na"].to_numpy() + col["nb"].to_numpy())
            ok = np.zeros(len(need), bool)
            for i, (x, y) in enumerate(zip(_vectors(col["ca"]), _vectors(col["cb"]))):
                g = min(len(x), len(y))
                ok[i] = (100 + percent) * int(np.minimum(folded(x, g), folded(y, g)).sum(dtype=np.int64)) >= need[i]
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([col[c].filter(keep) for c in ("a", "b", "da", "db")], names=["a", "b", "da", "db"])

    return both.select("a", "b", "da", "db", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long, da long, db long")


def _vectors(lists: pa.Array) -> list[np.ndarray]:
    at = lists.offsets.to_numpy()
    return np.split(lists.flatten().to_numpy(), (at[1:-1] - at[0])) if len(lists) else []


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, text) of ``wanted`` (sid, doc_id). Few documents are wanted as a
    rule: a table of at most FILTER_CELLS hashes, broadcast, keeps most others from being moved."""
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_CELLS))
    cells = wanted.select(cell.alias("cell")).distinct()
    some = docs.join(F.broadcast(cells), cell == F.col("cell"), "left_semi")
    return some.join(wanted, "doc_id").select("sid", "text")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets' Jaccard similarity is at least ``percent``."""
    near = table(bounded(pairs, sets, percent))
    wanted = near.select(F.col("a").alias("sid"), F.col("da").alias("doc_id")).unionByName(near.select(F.col("b").alias("sid"), F.col("db").alias("doc_id"))).distinct()
    texts = table(texts_of(docs, wanted))
    both = near.select("a", "b").join(texts.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(shingle_sets(batch.column(2), width), shingle_sets(batch.column(3), width))):
                if set_id(x) == a[i] and set_id(y) == b[i]:  # a doc_id may stand for another text, too
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], names=["a", "b"])

    links = table(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct())
    drop(texts)
    drop(near)
    return links


class CountTree:
    """A packed R-tree over group-count vectors: rows sorted by size, LEAF to a box.

    Each box keeps its points' coordinate maxima, smallest size, and smallest
    and largest label.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.order = np.lexsort((labels, sizes))
        self.counts, self.sizes, self.labels = counts[self.order], sizes[self.order], labels[self.order]
        self.levels = [(self.counts, self.sizes, self.sizes, self.labels, self.labels)]
        while len(self.levels[-1][0]) > 1:
            top, small, large, low, high = self.levels[-1]
            cut = np.arange(0, len(top), LEAF)
            self.levels.append((np.maximum.reduceat(top, cut), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def pairs(self, other: CountTree, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of both trees that may link and don't share a label, and what they share at most."""
        k = max(len(self.levels), len(other.levels)) - 1
        x = y = np.zeros(1, np.int64)
        while True:
            a, b = self.levels[min(k, len(self.levels) - 1)], other.levels[min(k, len(other.levels) - 1)]
            keep = ~((a[3][x] == a[4][x]) & (b[3][y] == b[4][y]) & (a[3][x] == b[3][y]))
            keep &= (100 * a[2][x] >= percent * b[1][y]) & (100 * b[2][y] >= percent * a[1][x])
            x, y = x[keep], y[keep]
            shared = np.zeros(len(x), np.int64)
            for i in range(0, len(x), 4096):  # bounded working memory
                u, v = x[i : i + 4096], y[i : i + 4096]
                shared[i : i + 4096] = np.minimum(a[0][u], b[0][v]).sum(axis=1, dtype=np.int64)
            ok = (100 + percent) * shared >= percent * (a[1][x] + b[1][y])
            x, y, shared = x[ok], y[ok], shared[ok]
            if k == 0:
                return self.order[x], other.order[y], shared
            k -= 1
            x, y = _children(x, y, self, other, k)


def _children(x, y, one: CountTree, two: CountTree, k: int):
    """All pairs of the children, at level k, of the pairs of boxes (x, y)."""

    def below(i, tree):
        if k >= len(tree.levels) - 1:  # this tree is not as high: stay at its root
            return i[:, None], np.ones((len(i), 1), bool)
        c = i[:, None] * LEAF + np.arange(LEAF)
        return c, c < len(tree.levels[k][0])

    (cx, okx), (cy, oky) = below(x, one), below(y, two)
    ok = okx[:, :, None] & oky[:, None, :]
    return np.broadcast_to(cx[:, :, None], ok.shape)[ok], np.broadcast_to(cy[:, None, :], ok.shape)[ok]


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _cell_pairs(sid, label, n, chunk, counts, one, two, percent, best):
    """Pairs of sets of chunks ``one`` and ``two`` that may link; counts: a vector for each row."""
    groups = np.array([len(c) for c in counts])
    trees: dict[tuple, tuple] = {}

    def tree(which, of, g):  # the rows of a chunk with ``of`` groups, in g groups
        if (which, of, g) not in trees:
            rows = np.flatnonzero((chunk == which) & (groups == of))
            trees[which, of, g] = rows, CountTree(np.stack([folded(counts[i], g) for i in rows]), n[rows], label[rows]) if len(rows) else None
        return trees[which, of, g]

    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    for left in np.unique(groups):
        for right in np.unique(groups):
            g = min(left, right)
            (first, x), (second, y) = tree(one, left, g), tree(two, right, g)
            if x is None or y is None or (one == two and left > right):
                continue
            a, b, shared = x.pairs(y, percent)
            found.append((first[a], second[b], shared))
    a, b, shared = (np.concatenate(x) for x in zip(*found))
    if best and len(a):  # for each set, the partner that is most alike
        alike = shared / (n[a] + n[b])
        keep = np.zeros(len(a), bool)
        for own in (a, b):
            by = np.lexsort((alike, own))
            keep[by[np.append(np.diff(own[by]) != 0, True)]] = True
        a, b = a[keep], b[keep]
    a, b = sid[a], sid[b]
    return np.minimum(a, b), np.maximum(a, b)


def tree_candidates(rows: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of sets that may link, from rows (t, one, two, chunk, sid, label, n, counts).

    Rows arrive sorted by cell (t, one, two); a cell holds at most two chunks
    of a block, and is all that a task keeps at a time. ``best``: only each
    set's most alike partner in a cell.
    """

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch])
            got, rest = cells(table.combine_chunks(), last=False)
            yield got
        if rest is not None:
            yield cells(pa.Table.from_batches([rest]), last=True)[0]

    def cells(table, last):
        n_rows = table.num_rows
        t, one, two, chunk, sid, label, n = (table.column(i).to_numpy() for i in range(7))
        cut = np.flatnonzero((np.diff(t) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)) + 1
        cuts = np.concatenate([[0], cut, [n_rows]])
        if not last:
            cuts = cuts[:-1]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        counts = _vectors(_one(table.column(7).slice(0, int(cuts[-1]))))
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j - i > 1:
                found.append(_cell_pairs(sid[i:j], label[i:j], n[i:j], chunk[i:j], counts[i:j], one[i], two[i], percent, best))
        a, b = np.unique(np.stack([np.concatenate(x) for x in zip(*found)], axis=1), axis=0).T if len(found) > 1 else found[0]
        out = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        left = table.slice(int(cuts[-1]))
        return out, (left.combine_chunks().to_batches() or [None])[0] if not last else None

    cell = ["t", "one", "two"]
    sorted_rows = rows.select("t", "one", "two", "chunk", "sid", "label", "n", "counts").repartition(*cell).sortWithinPartitions(*cell)
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, rounds: int = 1) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text, any others).

    A null or blank text has no shingles and links with nothing. A row whose
    doc_id is null is returned with a null component_id and takes no part in
    any link. Rows that repeat a doc_id are returned each; repeated texts are
    one node and share a component. ``component_id`` is the smallest doc_id
    that links reach. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, width))
    full = table(nodes(docs, sketch, width, percent))
    sketch.destroy()  # the written table needs it no more
    own = table(full.select("doc_id", "sid", "n"))
    labels = _labels(docs, full, width, percent, rounds)

    out = own.join(labels, "sid", "left")
    # sets without links: the set itself; documents without shingles: each by itself
    out = out.withColumn("label", F.coalesce("label", "sid")).withColumn("lone", F.when(F.col("n") == 0, F.col("doc_id")))
    out = checkpoint(out.select("doc_id", "n", "label", "lone"))
    least = out.where("doc_id is not null and n > 0").groupBy("label").agg(F.min("doc_id").alias("component"))
    out = out.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("lone", "component")).alias("component_id"))


def _labels(docs: DataFrame, full: DataFrame, width: int, percent: int, rounds: int) -> DataFrame:
    """(sid, label) of the sets that have links; label is the same within a component. Drops ``full`` when it is used up."""
    real = full.where("doc_id is not null and n > 0")
    tokens = real.select("sid", F.explode("prefix").alias("t"))
    shared = tokens.groupBy("t").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo <> hi").select("t")
    blocks = table(tokens.join(shared, "t").select("t", "sid").distinct())
    sets = real.join(blocks.select("sid").distinct(), "sid", "left_semi")
    sets = table(sets.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("counts").alias("counts")))
    drop(full)

    links = labels = None
    for k in range(rounds + 2):
        rows = blocks if labels is None else blocks.join(labels, "sid", "left")
        rows = rows.select("t", "sid", F.coalesce("label", "sid").alias("label") if labels is not None else F.col("sid").alias("label"))
        if k < rounds:
            draw = F.struct(F.xxhash64("sid", F.lit(k)).alias("h"), F.col("sid").alias("hub"), F.col("label").alias("hub_label"))
            hubs = rows.groupBy("t").agg(F.min(draw).alias("d"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
            near = rows.join(hubs.select("t", "d.hub", "d.hub_label"), "t").where("label <> hub_label")
            best = near.groupBy("sid", "hub").agg(F.count("*").alias("c")).groupBy("sid").agg(F.max(F.struct("c", "hub")).alias("m"))
            pairs = best.select(F.least("sid", "m.hub").alias("a"), F.greatest("sid", "m.hub").alias("b")).distinct()
        elif k == rounds:  # a few blocks of each set will do to connect most: the last pass takes all
            place = F.row_number().over(W.partitionBy("sid").orderBy(F.xxhash64("t"), "t"))
            few = rows.withColumn("place", place).where(F.col("place") <= BEST_BLOCKS).drop("place")
            pairs = tree_candidates(_cells_of(few, sets), percent, best=True)
        else:
            pairs = tree_candidates(_cells_of(rows, sets), percent, best=False)
        found = verified(pairs, sets, docs, width, percent)
        links = found if links is None else links.unionByName(found)
        labels = checkpoint(connected_components(links).select(F.col("node").alias("sid"), F.col("component").alias("label")))
    return labels


def _cells_of(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (t, sid, label) of the blocks that are not all connected, dealt into
    cells of two chunks. Blocks with the same sets are joined once."""
    what = rows.groupBy("t").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"), F.min("sid").alias("first"), F.max("sid").alias("last"),
        F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("h"), F.sum(F.xxhash64("sid", F.lit(1)).cast("decimal(20,0)")).alias("h2"),
    )
    what = what.where("lo <> hi").groupBy("m", "first", "last", "h", "h2").agg(F.min("t").alias("t"))
    what = what.select("t", F.ceil(F.col("m") / CHUNK).cast("long").alias("chunks"))
    mine = rows.join(what, "t").withColumn("chunk", F.expr("pmod(xxhash64(sid, 7), chunks)"))
    mine = mine.withColumn("with", F.explode(F.expr("sequence(0L, chunks - 1)")))
    mine = mine.select("t", F.least("chunk", "with").alias("one"), F.greatest("chunk", "with").alias("two"), "chunk", "sid", "label")
    return mine.join(sets.select("sid", "n", "counts"), "sid")
