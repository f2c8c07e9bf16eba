"""Survey CSV with damaged rows told apart, and every row's file as lineage.

A permissive read cuts a row with too many fields and pads one with too few, both
without a trace. :func:`read_checked` keeps the text of each row whose number of
fields is not the header's, and :func:`damage_rules` turn it into reject
reasons, so such rows reach the quarantine with their file and full text:

* ``torn_row``: a quote that never closes (a multi-line read swallows what follows, the text keeps it)
* ``long_row`` / ``short_row``: more / fewer fields than the header
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paysift.operators.forms import FormSpec, Rule
from paysift.sources.csv_forms import form_columns, read_raw_csv

DAMAGED, SOURCE_FILE = "damaged_text", "source_file"
#: What a checked read adds to the form's columns.
LINEAGE = (SOURCE_FILE, DAMAGED)


def header_of(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    return read_raw_csv(spark, path, multi_line).columns


def read_checked(
    spark: SparkSession, path: str, spec: FormSpec, multi_line: bool = True, header: list[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The form's columns, ``source_file``, and ``damaged_text``: the row's own text
    if its fields aren't as many as the header's, else null.

    All columns are parsed (a pruned read could not count the fields).
    ``header`` spares the job that reads it from a file; ``keep`` names other columns of it to pass on.
    """
    names = header or header_of(spark, path, multi_line)
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", DAMAGED)
        .option("columnPruning", False)
        .schema(StructType([StructField(n, StringType()) for n in [*names, DAMAGED]]))
        .csv(path)
    )
    return raw.select(*keep, F.col("_metadata.file_path").alias(SOURCE_FILE), DAMAGED, *form_columns(spec))


def _outside_quotes() -> Column:
    return F.regexp_replace(DAMAGED, '"[^"]*"', "")


def _torn() -> Column:
    return _outside_quotes().contains('"')


def _fields() -> Column:
    bare = _outside_quotes()
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def damage_rules(width: int) -> tuple[Rule, ...]:
    """Reject rules for rows of :func:`read_checked`; ``width`` is the header's number of fields."""
    return (
        Rule("torn_row", lambda: F.coalesce(_torn(), F.lit(False))),
        Rule("long_row", lambda: F.coalesce(~_torn() & (_fields() > width), F.lit(False))),
        Rule("short_row", lambda: F.coalesce(~_torn() & (_fields() <= width), F.lit(False))),
    )
