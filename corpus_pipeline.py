"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on;
:func:`run` writes each stage's result and reads it again as the next one's
input. The last stage returns the mix: which documents, how often and how many
of their tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.llm import decontaminate, exact_dedup, language_id, mixing, ngram_jaccard
from paysift.llm.queries import MAX_EPOCHS, SEED, mix_levels, read
from paysift.llm.store import table

#: SQL can't express the language model of the first stage: tested against brute force instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; texts without letters go."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id.
    Rows without a doc_id stay, as do documents without words."""
    found = ngram_jaccard.jaccard_components(docs)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to the target weights, with as many tokens as the documents have."""
    return mixing.mix(docs, mix_levels(), None, MAX_EPOCHS, SEED)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontaminate", drop_benchmark_passages),
    ("source_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a written table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
