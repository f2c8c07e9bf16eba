"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds every window of ten consecutive words of the benchmark's
normalised questions and answers (a shorter item is one window). Its letters are
the numbers of the benchmark's words, so it has a node for a word, not for a
character. A document is normalised the same way and scanned once; each match
marks its words, whose offsets are mapped back to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.llm.store import table

WINDOW = 10
#: Words of benchmark text in one automaton; a larger benchmark is scanned for in several. Each word
#: is the start of a window, so these are up to ten times as many nodes, of about 60 bytes.
AUTOMATON_WORDS = 100_000
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
#: Bytes of words stay (A-Z as a-z), all others become a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: What a scan returns, for Spark and for Arrow.
RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>, hits array<struct<first: long, last: long>>"
_RUNS = {names: pa.list_(pa.struct([(n, pa.int64()) for n in names])) for names in (("start", "end"), ("first", "last"))}
_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _RUNS["start", "end"]), ("hits", _RUNS["first", "last"])])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def windows_of(text: str | None, size: int = WINDOW) -> set[str]:
    """The windows of an item, as the automaton's keys: words between single spaces."""
    words = words_of(text)
    size = min(size, len(words))
    return {f" {b' '.join(words[i : i + size]).decode()} " for i in range(len(words) - size + 1)} if words else set()


class Machine:
    """Automaton over windows (words between single spaces) and the items that have each of them."""

    def __init__(self, owners: dict[str, set]):
        self.words: dict[bytes, int] = {}
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, of in owners.items():
            window = tuple(self.words.setdefault(w, len(self.words) + 1) for w in key.encode().split())
            self.found.add_word(window, (len(window), tuple(x for x in of if x is not None)))
        self.found.make_automaton()

    def matches(self, words: list[bytes]) -> list[tuple[int, tuple[int, tuple[str, ...]]]]:
        """(last word, (words, items)) of each occurrence; 0 is no word of any window."""
        numbers = tuple(self.words.get(w, 0) for w in words)
        return list(self.found.iter(numbers)) if any(numbers) else []


def automaton(items: list[tuple[str | None, str | None]], size: int = WINDOW) -> Machine | None:
    """Automaton over the windows of (item_id, text); None if there are none."""
    owners: dict[str, set] = {}
    for item, text in items:
        for key in windows_of(text, size):
            owners.setdefault(key, set()).add(item)
    return Machine(owners) if owners else None


def merged_runs(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, last) of words, with those that touch or overlap made one."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted(hits):
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = runs[-1][0], max(last, runs[-1][1])
        else:
            runs.append((first, last))
    return runs


def scan(text: str | None, machine) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, merged runs of hit words as (first, last), items found)."""
    words = words_of(text)
    if machine is None or not words:
        return len(words), [], set()
    matches = machine.matches(words)
    if not matches:
        return len(words), [], set()
    runs = merged_runs([(last - k + 1, last) for last, (k, _) in matches])
    return len(words), runs, {x for _, (_, of) in matches for x in of}


def original_spans(text: str | None, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as offsets (code points, end exclusive) of the original text."""
    if not runs:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


def _scanner(spark, items: list[tuple[str | None, str | None]], size: int):
    shared = spark.sparkContext.broadcast(items)

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = automaton(shared.value, size)
        for batch in batches:
            rows = []
            for cell in batch:
                n, runs, of = scan(text := cell.as_py(), machine)
                rows.append(_row(n, runs, sorted(of), original_spans(text, runs)) | {"hits": [{"first": a, "last": b} for a, b in runs]})
            yield pa.array(rows, _RESULT)

    return run


def _row(n_words: int, runs: list[tuple[int, int]], items: list[str], spans: list[tuple[int, int]]) -> dict:
    return {"n_words": n_words, "n_hit": sum(b - a + 1 for a, b in runs), "items": items, "spans": [{"start": a, "end": b} for a, b in spans], "hits": []}


def with_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """``docs`` as (row: all its columns, hit: struct with n_words, n_hit, items, spans).

    The benchmark's words are counted first. Up to ``automaton_words`` of them are
    broadcast as one automaton; a larger one is dealt by hash into parts of
    about that size, the documents are scanned once for each part, and the
    parts' hits are merged in a written table.
    """
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    counted = F.size(F.regexp_extract_all("text", F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+)"), F.lit(1)))
    total = items.agg(F.sum(counted.cast("long")).alias("n")).first()["n"] or 0
    parts = -(-total // automaton_words) or 1
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    part = lambda k: [tuple(r) for r in (items if parts == 1 else items.where(deal == k)).collect()]
    if parts == 1:
        hit = _scanner(spark, part(0), size)(F.col("row.text"))
        return rows.select("row", hit.alias("hit")).select("row", F.col("hit").dropFields("hits").alias("hit"))
    rows = table(rows.withColumn("place", F.monotonically_increasing_id()))
    found = None
    for k in range(parts):
        one = table(rows.select("place", _scanner(spark, part(k), size)(F.col("row.text")).alias("hit")).where("hit.n_hit > 0"))
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("place").agg(F.flatten(F.collect_list("hit.hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit.items")))).alias("items"))
    return rows.join(merged, "place", "left").select("row", _merged(F.col("row.text"), F.col("hits"), F.col("items")).alias("hit"))


def _merged(text, hits, items):
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for cells in zip(*batch):
                t, h, of = (x.as_py() for x in cells)
                runs = merged_runs([(x["first"], x["last"]) for x in h or ()])
                rows.append(_row(len(words_of(t)), runs, of or [], original_spans(t, runs)))
            yield pa.array(rows, _RESULT)

    return run(text, hits, items).dropFields("hits")


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) for every row of ``docs``.

    ``spans`` are the hit runs as offsets of the original text (code points).
    A null or wordless text has no words and no hits; null or wordless items
    have no windows; an item with a null item_id hits but isn't listed. Items
    that repeat an item_id count once. Repeated documents are returned each;
    an empty table gives no rows, an empty benchmark no hits.
    """
    out = with_hits(docs, benchmark, size, automaton_words).select("row.doc_id", "hit.*")
    return out.select(
        "doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    return with_hits(docs, benchmark, size).where("hit.n_hit = 0").select("row.*")
