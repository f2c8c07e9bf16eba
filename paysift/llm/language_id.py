"""Language identification by word-first backoff.

A known word scores with its log frequency in each language. A word that the
model hasn't seen falls back to its character n-grams, longest first: the
first length with any known n-gram gives the mean of their log frequencies.
The language with the largest sum over the whole text wins; the score is its
share after the sums are turned into probabilities.

Words are runs of Unicode letters and the marks on them. The model is a sorted
array of 64-bit name hashes with the counts of each language that has the name,
about 25 bytes a name, so Spark can broadcast it with the function that uses it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.llm.sampling import sample

UNKNOWN = "und"
LONGEST = 5
#: Training rows of each language, as expected from a hash sample; they bound the model. Nothing that they hold is left out.
SAMPLE_ROWS = 4_000
#: Tokens whose scores a task keeps at hand, and characters of the texts that it takes at a time.
CACHE_WORDS, SLICE = 100_000, 1 << 20
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LETTER = regex.compile(r"\p{L}")


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def hashes(names: Iterable[str], kind: int) -> np.ndarray:
    """64-bit hashes of words (kind 0) or n-grams (kind n)."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(name, kind) for name in names), np.uint64)


class Model:
    """Log frequencies of names: of words (kind 0) and of n-grams (kind n).

    A name that occurs c times in a language has frequency (c + 0.5) / (all of
    its kind there + 0.5 for each name of its kind + 1).
    """

    def __init__(self, langs: list[str], lang: np.ndarray, kind: np.ndarray, name: np.ndarray, count: np.ndarray):
        order = np.lexsort((lang, name))
        lang, kind, name, count = lang[order], kind[order], name[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]])) if len(name) else np.zeros(0, np.int64)
        self.langs = langs
        self.names, self.kinds = name[first], kind[first].astype(np.uint8)
        self.starts = np.append(first, len(name)).astype(np.int32)
        self.lang, self.count = lang.astype(np.uint16), np.minimum(count, np.iinfo(np.int32).max).astype(np.int32)
        totals = np.bincount(kind * max(len(langs), 1) + lang, weights=count, minlength=(LONGEST + 1) * len(langs)).reshape(LONGEST + 1, len(langs))
        self.logs = np.log(totals + 0.5 * np.bincount(self.kinds, minlength=LONGEST + 1)[:, None] + 1)

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the hashes are known, the log frequencies of those in each language)."""
        if not len(self.names):
            return np.zeros(0, np.int64), np.zeros((0, len(self.langs)))
        at = np.minimum(np.searchsorted(self.names, asked), len(self.names) - 1)
        known = np.flatnonzero(self.names[at] == asked)
        at = at[known]
        counts = np.full((len(at), len(self.langs)), 0.5)
        many = self.starts[at + 1] - self.starts[at]
        row = np.repeat(np.arange(len(at)), many)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.starts[at], many)
        counts[row, self.lang[entry]] += self.count[entry]
        return known, np.log(counts) - self.logs[self.kinds[at]]

    def knows(self, name: str, kind: int = 0) -> bool:
        return len(self.find(hashes([name], kind))[0]) == 1

    def scores(self, words: list[str]) -> np.ndarray:
        """The score of each word in each language: its own, or the mean of its longest known n-grams."""
        out = np.zeros((len(words), len(self.langs)))
        known, rows = self.find(hashes(words, 0))
        out[known] = rows
        open_ = np.setdiff1d(np.arange(len(words)), known)
        for n in range(LONGEST, 0, -1):
            if not len(open_):
                break
            parts = [grams(words[i], n) for i in open_]
            owner = np.repeat(np.arange(len(open_)), [len(p) for p in parts])
            known, rows = self.find(hashes((g for p in parts for g in p), n))
            met = np.bincount(owner[known], minlength=len(open_))
            sums = np.zeros((len(open_), len(self.langs)))
            np.add.at(sums, owner[known], rows)
            told = met > 0
            out[open_[told]] = sums[told] / met[told, None]
            open_ = open_[~told]
        return out


def held_out() -> Column:
    """True for the documents that training must not see: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


_COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("name", pa.int64()), ("c", pa.int64())])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from text and lang of the rows of ``docs`` that aren't held out.

    Rows with a null text, lang or doc_id teach nothing. The rows used are a
    hash sample of each language with ``sample_rows`` expected rows (all, if
    the language has no more), so a rare language is learned at any size.
    Every word and n-gram of these rows is learned; Spark adds up the counts
    and the driver gets one row of four numbers for each name and language.
    """
    rows = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out()).select("doc_id", "lang", "text")
    rows = sample(rows, sample_rows, "lang", "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                words.setdefault(lang, Counter()).update(WORD.findall(text.as_py().lower()))
            for lang, seen in words.items():
                for k in range(LONGEST + 1):
                    found = seen if k == 0 else Counter()
                    for word, c in seen.items() if k else ():
                        for g in grams(word, k):
                            found[g] += c
                    n = len(found)
                    columns = [pa.array([lang] * n, pa.string()), pa.array([k] * n, pa.int32()), pa.array(hashes(found, k).view(np.int64)), pa.array(list(found.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, kind int, name long, c long")
    counts = counts.groupBy("lang", "kind", "name").agg(F.sum("c").alias("c")).toArrow().combine_chunks()
    langs = sorted(counts["lang"].unique().to_pylist())
    at = {lang: i for i, lang in enumerate(langs)}
    coded = counts["lang"].combine_chunks().dictionary_encode()
    lang = np.array([at[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if langs else np.zeros(0, np.int64)
    return Model(langs, lang, counts["kind"].to_numpy().astype(np.int64), counts["name"].to_numpy().view(np.uint64), counts["c"].to_numpy())


class _Words(dict):
    """Token -> row of a matrix of scores; a bounded cache."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.matrix = model, np.zeros((0, len(model.langs)))

    def learn(self, tokens: Iterable[str]) -> None:
        """Score the tokens that aren't known yet."""
        new = [t for t in tokens if t not in self]
        if not new:
            return
        parts = [WORD.findall(t) for t in new]
        words = list(dict.fromkeys(w for p in parts for w in p))
        place = {w: i for i, w in enumerate(words)}
        scores = self.model.scores(words)
        sums = np.zeros((len(new), len(self.model.langs)))
        np.add.at(sums, np.repeat(np.arange(len(new)), [len(p) for p in parts]), scores[[place[w] for p in parts for w in p]])
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.matrix = np.concatenate([self.matrix, sums])

    def shrink(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.matrix = self.matrix[:0]


def predict_texts(texts: list[str | None], words: _Words) -> list[tuple[str, float]]:
    """(language, score) of each text; ('und', 0.0) for a null text or one without letters."""
    langs = words.model.langs
    tokens = [text.lower().split() if langs and text is not None and LETTER.search(text) else None for text in texts]
    words.shrink()
    words.learn({t for some in tokens if some for t in some})
    out = []
    for some in tokens:
        if some is None:
            out.append((UNKNOWN, 0.0))
            continue
        sums = np.zeros(len(langs))
        for i in range(0, len(some), SLICE):
            sums += words.matrix[[words[t] for t in some[i : i + SLICE]]].sum(axis=0)
        shares = np.exp(sums - sums.max())
        best = int(np.argmax(shares))
        out.append((langs[best], float(shares[best] / shares.sum())))
    return out


def predict_text(text: str | None, words: _Words) -> tuple[str, float]:
    return predict_texts([text], words)[0]


def _sliced(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch, about SLICE characters (one text at least) at a time."""
    some, size = [], 0
    for text in batch:
        some.append(text.as_py())
        size += len(some[-1] or "")
        if size >= SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def predictor(spark: SparkSession, model: Model):
    """A column function text -> struct<lang_pred, score>. The model's size is bounded by
    its training rows (see :func:`train`); it goes with the tasks that use it."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _Words(model)
        for batch in batches:
            found = [p for texts in _sliced(batch) for p in predict_texts(texts, words)]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang, any others).

    Only the text is looked at to predict. Null texts and texts without a
    letter are 'und' with score 0; so is every text when there is nothing to
    learn from. Between languages that score the same, the first by name wins.
    A null doc_id isn't held out. Repeated rows are returned each; an empty
    table gives no rows.
    """
    predict = predictor(docs.sparkSession, train(docs, sample_rows))
    return docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, min_score: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose language is identified with at least ``min_score``, all columns as they are."""
    predict = predictor(docs.sparkSession, train(docs, sample_rows))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict("text").alias("p"))
    return rows.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_score)).select("row.*")
