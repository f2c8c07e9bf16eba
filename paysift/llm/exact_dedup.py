"""Exact deduplication over a cuckoo-filter index of live text digests.

Texts are equal when identical after each run of ASCII white space became one
space; the digest is the SHA-256 of that text in UTF-8. The index of a partition
is a cuckoo filter (two buckets of four 16-bit fingerprints for each digest)
with the full digests stored bucket by bucket. A probe that misses is a new
digest; a probe that hits is verified against the content of its bucket, so a
shared fingerprint never merges two texts. An insertion that finds no room
after a bounded number of moves doubles the filter and fills it again from the
stored digests.

Deduplication uses the index twice: each input task folds its own repeated rows
into one row per digest (so a digest that a third of all rows share sends one
row per task), then digests meet by hash and each task folds what arrives.
Live use keeps one filter per hash range as a table; see :func:`apply_changes`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paysift.llm.store import table

SLOTS = 4
MAX_MOVES = 200
#: Digests that a task holds before it hands them on.
HELD = 1 << 16
#: Groups of more than this part (one in so many) of all rows are joined by broadcast.
HOT = 10_000


class CuckooIndex:
    """Digest -> list of values, found through a cuckoo filter."""

    def __init__(self, buckets: int = 1024):
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = np.zeros((buckets, SLOTS), np.uint16)  # 0: free
        self.content: list[list] = [[None] * SLOTS for _ in range(buckets)]
        self.size = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        fp = int.from_bytes(digest[:2], "little") or 1
        one = int.from_bytes(digest[8:16], "little") & self.mask
        return fp, one, self._other(one, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * 0x5BD1E995 >> 3) & self.mask)

    def find(self, digest: bytes):
        """The stored entry [digest, value], or None."""
        fp, one, two = self._places(digest)
        for b in (one, two):
            for slot in np.flatnonzero(self.prints[b] == fp):
                entry = self.content[b][slot]
                if entry[0] == digest:  # a hit counts only when the content agrees
                    return entry
        return None

    def insert(self, digest: bytes, value) -> None:
        """Add a digest that is not in the index."""
        entry = [digest, value]
        while (entry := self._place(entry)) is not None:
            self._grow(entry)
            entry = self._held
        self.size += 1

    def _place(self, entry):
        fp, one, two = self._places(entry[0])
        for b in (one, two):
            free = np.flatnonzero(self.prints[b] == 0)
            if len(free):
                self.prints[b, free[0]], self.content[b][free[0]] = fp, entry
                return None
        b = one
        for move in range(MAX_MOVES):
            slot = move % SLOTS
            fp_out, out = int(self.prints[b, slot]), self.content[b][slot]
            self.prints[b, slot], self.content[b][slot] = fp, entry
            fp, entry, b = fp_out, out, self._other(b, fp_out)
            free = np.flatnonzero(self.prints[b] == 0)
            if len(free):
                self.prints[b, free[0]], self.content[b][free[0]] = fp, entry
                return None
        return entry

    def _grow(self, waiting) -> None:
        """Double the filter and fill it again from the stored digests."""
        old = [e for bucket in self.content for e in bucket if e is not None]
        buckets, size = 2 * (self.mask + 1), self.size
        while True:
            self._empty(buckets)
            if all(self._place(e) is None for e in old):
                break
            buckets *= 2
        self.size, self._held = size, waiting

    def delete(self, digest: bytes) -> bool:
        fp, one, two = self._places(digest)
        for b in (one, two):
            for slot in np.flatnonzero(self.prints[b] == fp):
                if self.content[b][slot][0] == digest:
                    self.prints[b, slot], self.content[b][slot] = 0, None
                    self.size -= 1
                    return True
        return False

    def entries(self) -> Iterator[list]:
        return (e for bucket in self.content for e in bucket if e is not None)


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, sha): sha is the normalised text's SHA-256 in lowercase hex."""
    return docs.select(*digests_of(docs))


def _fold(rows: DataFrame) -> DataFrame:
    """Fold rows (digest, least, n) to one per digest within each partition."""

    def run(batches):
        index = CuckooIndex()
        for batch in batches:
            for digest, least, n in zip(*(c.to_pylist() for c in batch.columns)):
                entry = index.find(digest)
                if entry is None:
                    index.insert(digest, [least, n])
                else:
                    have = entry[1]
                    have[0] = least if have[0] is None else have[0] if least is None else min(least, have[0])
                    have[1] += n
            if index.size >= HELD:  # bounded memory: hand on, a later fold meets the rest
                yield _rows(index)
                index = CuckooIndex()
        yield _rows(index)

    return rows.select("digest", "least", "n").mapInArrow(run, "digest binary, least long, n long")


def _rows(index: CuckooIndex) -> pa.RecordBatch:
    entries = list(index.entries())
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in entries], pa.binary()), pa.array([v[0] for _, v in entries], pa.int64()), pa.array([v[1] for _, v in entries], pa.int64())],
        names=["digest", "least", "n"],
    )


def groups(rows: DataFrame) -> DataFrame:
    """(sha, keep_id, group_size) per distinct digest of rows (doc_id, sha)."""
    local = _fold(rows.select(F.unhex("sha").alias("digest"), F.col("doc_id").alias("least"), F.lit(1).cast("long").alias("n")))
    met = _fold(local.repartition("digest"))
    # a task that handed on more than once holds several rows of a digest
    met = met.groupBy("digest").agg(F.min("least").alias("keep_id"), F.sum("n").alias("group_size"))
    return met.select(F.lower(F.hex("digest")).alias("sha"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Of equal texts the row with the smallest doc_id is kept; null doc_ids count
    as larger than all others (keep_id is null where a group has no other).
    Rows that repeat both doc_id and text: one of them is kept. A null text
    equals an empty one. Other columns of ``docs`` are ignored. An empty table
    gives no rows.
    """
    rows = table(digests(docs).withColumn("place", F.monotonically_increasing_id()))
    met = table(groups(rows))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # groups of more than one HOT-th of all rows are fewer than HOT: they meet their rows by broadcast, wherever these are
    hot = met.where(F.col("group_size") * HOT > rows.count())
    many = rows.join(F.broadcast(hot), "sha")
    first = many.where(stays).groupBy("sha").agg(F.min("place").alias("first"))
    many = many.join(F.broadcast(first), "sha").withColumn("kept", F.col("place") == F.col("first"))

    few = rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(met, "sha")
    nth = F.row_number().over(W.partitionBy("sha", "doc_id").orderBy("place"))
    few = few.withColumn("kept", stays & (nth == 1))
    columns = ["doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")]
    return many.select(*columns).unionByName(few.select(*columns))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    Groups are found on digests alone; a text is moved only to meet the digest
    and doc_id that stay, which spreads a hot digest by doc_id.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *digests_of(docs))
    met = groups(rows.select("doc_id", "sha")).select("sha", F.coalesce("keep_id", F.lit(-(1 << 63))).alias("key"))
    kept = rows.select("sha", key.alias("key"), "row").join(met, ["sha", "key"])
    return kept.dropDuplicates(["sha", "key"]).select("row.*")


def digests_of(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("sha")]


def apply_changes(live: DataFrame, changes: DataFrame, ranges: int = 64) -> DataFrame:
    """The live index after ``changes``: a table (digest, doc_id, n) of live digests.

    ``changes`` has (seq, op, doc_id, text) with op 'insert' or 'delete',
    applied by seq within a digest. An insertion of a live digest adds to its
    count (n) and keeps its doc_id; a deletion takes one from it, and the
    digest leaves the index at zero; deleting what isn't live changes nothing.
    ``live`` may be empty. Rows with a null op or seq are ignored.
    """
    new = changes.where("op is not null and seq is not null").select("seq", "op", *digests_of(changes))
    new = new.select(F.unhex("sha").alias("digest"), "doc_id", F.when(F.col("op") == "delete", -1).otherwise(1).cast("long").alias("n"), F.col("seq").cast("long").alias("seq"))
    old = live.select("digest", "doc_id", "n", F.lit(-(1 << 62)).cast("long").alias("seq"))
    both = old.unionByName(new).repartition(ranges, "digest").sortWithinPartitions("seq", "doc_id")

    def run(batches):
        index = CuckooIndex()
        for batch in batches:
            for digest, doc_id, n, _ in zip(*(c.to_pylist() for c in batch.columns)):
                entry = index.find(digest)
                if entry is None:
                    if n > 0:
                        index.insert(digest, [doc_id, n])
                elif entry[1][1] + n <= 0:
                    index.delete(digest)
                else:
                    entry[1][1] += n
        yield _rows(index)

    return both.mapInArrow(run, "digest binary, least long, n long").withColumnRenamed("least", "doc_id")
