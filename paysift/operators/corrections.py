"""The way back of corrected rejects: a keyed merge with versions over plain Parquet.

A client who gets the quarantine corrects some rows and sends them back. They
go through the form's own rules again; what passes becomes part of the unified
table, once per key, whatever is sent twice. The table is dealt to buckets by a
hash of the key. A merge reads and rewrites only the buckets that it changes, as
new folders, and publishes them by one pointer file, so readers see all of a
merge or nothing of it, and a merge that dies leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.operators.clean import REASONS, process_form
from paysift.operators.forms import FormSpec, Rule
from paysift.operators.unify import UNIFIED_COLUMNS, to_unified
from paysift.sources.publish import current, new_version, point, pointers, remove, subfolders

VERSION = "version"
_BUCKET = "bucket"


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: that of the highest version; of equal versions, the one whose columns
    come last in order. An aggregate, so a key's many versions are reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, VERSION)]
    one = F.max(F.struct(VERSION, *[F.col(f"`{c}`") for c in rest])).alias("one")
    best = rows.groupBy(*keys).agg(one)
    return best.select(*[F.col("one")[c].alias(c) if c in (VERSION, *rest) else F.col(c) for c in rows.columns])


def merge(spark: SparkSession, base: str, rows: DataFrame, keys: Sequence[str], buckets: int = 64) -> list[int]:
    """Bring ``rows`` (*keys, version, other columns) into the keyed table under ``base``; the buckets that changed.

    A row replaces the table's row of its key if its version is higher; a key
    that the table doesn't have is added; null keys equal each other. The same
    rows again change nothing. ``buckets`` counts for a new table only; the table remembers it.
    """
    known = pointers(spark, base)
    folders = dict(known[0][1]) if known else {}
    n = int(folders.pop("buckets", buckets))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(_BUCKET)
    staged = f"{base}/{new_version(base)}"  # the merge reads its rows several times, but computes them once
    newest(rows, keys).write.parquet(staged)
    new = spark.read.schema(rows.schema).parquet(staged)
    try:
        return _merge_staged(spark, base, new, keys, folders, n, bucket)
    finally:
        remove(spark, staged)


def _merge_staged(spark: SparkSession, base: str, new: DataFrame, keys: Sequence[str], folders: dict[str, str], n: int, bucket: Column) -> list[int]:
    columns = new.columns
    if folders:
        new = _higher(spark, base, folders, new, keys, bucket)
        touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most n numbers
        if not touched:
            return []
        have = [f"{base}/{folders[str(b)]}" for b in touched if str(b) in folders]
        if have:
            new = newest(new.unionByName(spark.read.parquet(*have).select(*columns)), keys)
    version = new_version(base)
    new.select(*columns, bucket).write.partitionBy(_BUCKET).parquet(f"{base}/{version}")
    written = sorted(int(name.split("=")[1]) for name in subfolders(spark, f"{base}/{version}") if name.startswith(f"{_BUCKET}="))
    folders.update({str(b): f"{version}/{_BUCKET}={b}" for b in written})
    if written:
        point(spark, base, {**folders, "buckets": str(n)})
    return written


def _higher(spark: SparkSession, base: str, folders: dict[str, str], new: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """The rows of ``new`` whose version is above the table's, or whose key it doesn't have; reads keys and versions of their buckets."""
    asked = [str(r[0]) for r in new.select(bucket).distinct().collect()]
    have = [f"{base}/{folders[b]}" for b in asked if b in folders]
    if not have:
        return new
    held = spark.read.parquet(*have).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(VERSION).alias("__version"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return new.join(held, same, "left").where("__version is null or version > __version").select(*new.columns)


def read_merged(spark: SparkSession, base: str) -> DataFrame:
    """The keyed table as of the newest merge."""
    folders = [f for name, f in current(spark, base).items() if name != "buckets"]
    return spark.read.parquet(*folders)


def unified_rows(good: DataFrame, spec: FormSpec, keys: Sequence[str]) -> DataFrame:
    """A form's clean rows (*keys, version, fields) in the unified columns, keyed by form and ``keys``."""
    return to_unified(good, spec.form, [*keys, VERSION]).select(F.lit(spec.form).alias("form"), *keys, VERSION, *UNIFIED_COLUMNS)


def return_corrections(
    spark: SparkSession, base: str, corrected: DataFrame, spec: FormSpec, keys: Sequence[str], on_cast_fail: str = "null", extra_rules: Sequence[Rule] = ()
) -> DataFrame:
    """Clean ``corrected`` (*keys, version, the form's columns as text) and merge what passes
    into the unified table under ``base``; returns the rows that are rejected again."""
    result = process_form(corrected, spec, [*keys, VERSION], on_cast_fail, extra_rules)
    merge(spark, base, unified_rows(result.good, spec, keys), ["form", *keys])
    return result.rejected


def still_open(quarantined: DataFrame, spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The long quarantine's rows (form, *keys, ...) whose key the unified table doesn't have yet."""
    done = read_merged(spark, base).select("form", *keys)
    return quarantined.join(done, ["form", *keys], "left_anti")


__all__ = ["REASONS", "VERSION", "merge", "newest", "read_merged", "return_corrections", "still_open", "unified_rows"]
