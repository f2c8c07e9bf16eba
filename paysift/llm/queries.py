"""The registered queries of the operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.llm.decontaminate import find_contamination
from paysift.llm.exact_dedup import exact_dedup
from paysift.llm.html_text import extract_text
from paysift.llm.language_id import identify
from paysift.llm.licenses import scan_licenses
from paysift.llm.mixing import mix
from paysift.llm.ngram_jaccard import jaccard_components
from paysift.llm.periodic_runs import collapse_runs
from paysift.llm.quality_rules import apply_rules
from paysift.llm.secrets import scan_secrets
from paysift.llm.sentence_dedup import FEW_WORDS, remove_repeated_sentences
from paysift.llm.spelling_groups import group_spellings, word_counts
from paysift.llm.suffix_dedup import remove_repeats

#: Target weights of the registered mix: domains by number, languages by name; sources of a language weigh the same.
DOMAIN_WEIGHTS = {"0": 4, "1": 3, "2": 2, "3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2}
MAX_EPOCHS = 4
SEED = 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _weights(column: str, known: dict[str, int], other: int):
    out = F.lit(other)
    for name, w in known.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out


def mix_levels():
    """The tree of the registered mix: a source's domain is its number modulo 4, '(none)' without a number."""
    number = F.expr("try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as long) % 4")
    return [
        ("domain", number, _weights("domain", DOMAIN_WEIGHTS, 1)),
        ("lang", F.col("lang"), _weights("lang", LANG_WEIGHTS, 1)),
        ("source", F.col("source"), F.lit(1)),
    ]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), mix_levels(), None, MAX_EPOCHS, SEED)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept", "spans")


def op9_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_sentences(read(spark, sf_dir, "documents"), min_words=0, short=True, few_words=FEW_WORDS)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the decimal doc_id and g = h div 10, the words of every text with
    h % 10 = 0 repeat from word a = g % n on with period 1 + (n - a) div (3 + g % 8). A null doc_id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
    rows = docs.select("doc_id", "text", h.alias("h")).select("doc_id", "text", words.alias("words"), F.expr("h div 10 as g"))
    rows = rows.select("*", F.expr("g % nullif(size(words), 0) as a")).select("*", F.expr("1 + (size(words) - a) div (3 + g % 8) as p"))
    word = "transform(sequence(0L, size(words) - 1L), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)])"
    return rows.select("doc_id", F.expr(f"if(a is null, text, array_join({word}, ' ')) as text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    order = """array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1) else cast(sign(x.period - y.period) as int) end)"""
    found = found.withColumn("best", F.get(F.expr(order), 0))
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.expr(f"sha2({listed}, 256)").alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "documents")).drop("removed_lines")


def misspelt(doc_id, run):
    """The run, without the letter h % length if 31 divides h, the crc32 of `<doc_id>:<run>`. A null doc_id changes nothing."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % 31 == 0, cut).otherwise(run)


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(word_counts(read(spark, sf_dir, "documents"), spell=misspelt))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline.py`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mix,
        op2_secrets,
        op3_html_text,
        op4_licenses,
        op5_language_id,
        op6_ngram_jaccard,
        op7_exact_dedup,
        op8_suffix_dedup,
        op9_sentence_dedup,
        op10_decontaminate,
        op11_periodic_runs,
        op12_quality_rules,
        op13_spelling_groups,
        pipeline,
    )
}
