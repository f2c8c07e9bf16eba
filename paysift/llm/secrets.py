"""Secret scan: fixed patterns, and the guess cost of values in a credential's place.

The fixed patterns find assignments, access keys and long hex strings. For other
values that follow a credential's name, a dynamic programme finds the cheapest
way to guess the value, as the number of guesses (a power of ten) of a sequence
of segments: words by rank, dates, repeats, keyboard walks, and brute force. A
value that costs at least MIN_COST is a secret; "password: welcome" is not.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paysift.llm.store import table

#: The patterns of the three base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is found whole: it starts where the run starts
KINDS = ("assign", "access", "hex", "guess")

#: A credential's name, a separator, and a value without spaces or quotes.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth(?:orization)?|login|bearer)"""
    r"""["']?[\x20\t]*(?:[:=]|=>|\bis\b)[\x20\t]*["'`]?(?P<value>[^\s"'`<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
#: Guesses (a power of ten) from which a value counts as a secret.
MIN_COST = 10.0
#: Bound of the word list. A word of a rank beyond costs at least as much as any three letters by brute force (10 ** 4.2).
MAX_WORDS = 20_000
#: Words that guessers try first.
COMMON = "password qwerty admin letmein welcome login master secret changeme default guest root test user abc example dummy placeholder your here none null true false".split()
#: The rows of a keyboard.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_LOOKS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d|(?:19|20)\d\d")
#: Cost of starting another segment: its kind and length have to be guessed too.
SEGMENT = 0.5
LONGEST_WORD = 24

_near: dict[str, set[str]] = {}
for _r, _row in enumerate(KEY_ROWS):
    for _c, _key in enumerate(_row):
        _near[_key] = {_row[x] for x in (_c - 1, _c + 1) if 0 <= x < len(_row)}
        for _other in KEY_ROWS[max(0, _r - 1) : _r + 2]:
            _near[_key] |= {_other[x] for x in (_c - 1, _c, _c + 1) if _other is not _row and 0 <= x < len(_other)}


def _char_cost(c: str) -> float:
    size = 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000
    return math.log10(size)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Base-10 logarithm of the guesses of the cheapest segmentation of ``value``; 0 for an empty one.

    Takes time in proportion to the length: words, dates and repeated blocks
    have bounded length, and runs and walks are extended from their start.
    """
    n = len(value)
    low = value.lower()
    plain = "".join(_LOOKS.get(c, c) for c in low)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # (start, cost) of segments that end there
    run_start = walk_start = 0
    for i in range(n):
        if i and value[i] != value[i - 1]:
            run_start = i
        if i and low[i] not in _near.get(low[i - 1], ()):
            walk_start = i
        if i - run_start >= 2:  # one character again and again
            ends[i + 1].append((run_start, _char_cost(value[i]) + math.log10(i - run_start + 1)))
        if i - walk_start >= 2:  # 47 keys to start from, about four ways to go, few turns
            ends[i + 1].append((walk_start, math.log10(47) + math.log10(4) + 0.3 * (i - walk_start)))
        for size in range(2, 9):  # a block, then the same block again (and again)
            start = i + 1 - 2 * size
            if start >= 0 and value[start : start + size] == value[start + size : i + 1]:
                ends[i + 1].append((start + size, math.log10(2)))
        for size in range(3, min(LONGEST_WORD, i + 1) + 1):
            start = i + 1 - size
            rank = ranks.get(low[start : i + 1])
            changed = 0.0
            if rank is None and (rank := ranks.get(plain[start : i + 1])) is not None:
                changed = 1.0  # look-alike characters
            if rank is not None:
                capital = 0.0 if value[start : i + 1] == low[start : i + 1] else 0.3 if value[start + 1 : i + 1] == low[start + 1 : i + 1] else 1.0
                ends[i + 1].append((start, math.log10(rank + 1) + capital + changed))
    for start in range(n):
        if m := _DATE.match(value, start):
            ends[m.end()].append((start, math.log10(365 * 120) if m.end() - start > 4 else math.log10(120)))
    # free[j]: the last segment before j is brute force, which goes on without a new start
    best, free = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for j in range(1, n + 1):
        one = _char_cost(value[j - 1])
        free[j] = min(best[j - 1] + SEGMENT, free[j - 1]) + one
        best[j] = min([free[j], *(best[s] + SEGMENT + c for s, c in ends[j])])
    return best[n]


def find_secrets(text: str | None, ranks: dict[str, int], min_cost: float = MIN_COST) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of every span, sorted."""
    if not text:
        return []
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    known = sorted((a, b) for a, _, b in spans)
    at, reach = 0, 0  # how far the base spans reach that begin before the value's end
    for m in CONTEXT.finditer(text):
        value = m["value"].rstrip(".!?)]}")
        start, end = m.start("value"), m.start("value") + len(value)
        while at < len(known) and known[at][0] < m.end("value"):
            if known[at][0] >= end:  # it begins in what was taken off the value
                break
            reach = max(reach, known[at][1])
            at += 1
        if len(value) >= 6 and reach <= start and guess_cost(value, ranks) >= min_cost:
            spans.append((start, 3, end))
    return sorted(spans)


def learn_words(docs: DataFrame, max_words: int = MAX_WORDS) -> dict[str, int]:
    """Word -> rank: the common guesses, then the most frequent words of all of ``docs``, counted before the shuffle.

    The list takes all words of a count, or none: those of the highest counts,
    as long as they are ``max_words`` at most. So the driver gets these words and
    nothing else, however many partitions the counts have.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,24})"), F.lit(1))).alias("w"))
    counts = table(words.groupBy("w").agg(F.count("*").alias("c")))
    # words per count: the distinct counts of n words are fewer than the root of twice their sum
    above = W.orderBy(F.desc("c")).rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = counts.groupBy("c").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(above))
    least = sizes.where(F.col("upto") <= max_words).agg(F.min("c")).first()[0]
    top = [r.w for r in counts.where(F.col("c") >= least).orderBy(F.desc("c"), "w").collect()] if least is not None else []
    return {w: i + 1 for i, w in enumerate(dict.fromkeys([*COMMON, *top]))}


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, min_cost: float = MIN_COST) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans) for every row of ``docs`` (doc_id, text, any others).

    Spans are kind:start:end in code points, by start and then kind. Base spans
    are always reported; a guess span never overlaps one. A null text is empty
    and has none. Repeated rows are returned each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn_words(docs))
    result = pa.struct([(f"n_{name}", pa.int64()) for name in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())])

    @F.arrow_udf("n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = shared.value
        for batch in batches:
            rows = []
            for text in batch:
                spans = find_secrets(text.as_py(), ranks, min_cost)
                base = _joined([s for s in spans if s[1] < 3])
                counts = {f"n_{name}": sum(k == kind for _, k, _ in spans) for kind, name in enumerate(KINDS)}
                rows.append(counts | {"base_sha256": hashlib.sha256(base.encode()).hexdigest(), "spans": _joined(spans)})
            yield pa.array(rows, result)

    return docs.select("doc_id", run("text").alias("s")).select("doc_id", "s.*")
