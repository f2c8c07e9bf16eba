"""Survey CSV source (S1, P1, P2) and its writer.

The reader binds columns by header name, never by position: a file with extra
columns or another order still yields the right columns, and with
``enforceSchema=False`` a directory whose files disagree on the header fails
instead of being silently mis-read. Every column is read as a string.

Scale note: a multi-line CSV file cannot be split, so a scan gets one task
per file. Large inputs should arrive as many files (a directory); pass
``multi_line=False`` when answers are known to hold no line breaks, which
makes each file splittable by ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.operators.forms import FormSpec


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Headered CSV, all strings: quoted line breaks kept, ``""`` is a quote,
    an empty field is NULL, a short row is padded with NULL."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def form_columns(spec: FormSpec) -> list[Column]:
    """The form's columns picked by header text, under their short names."""
    return [F.col(_quoted(s.header)).alias(s.name) for s in spec.sources]


def select_form(raw: DataFrame, spec: FormSpec) -> DataFrame:
    return raw.select(*form_columns(spec))


def read_form(
    spark: SparkSession, path: str, spec: FormSpec, multi_line: bool = True, spread_to: int | None = None
) -> DataFrame:
    """The form's columns as renamed strings. A multi-line file is one task;
    ``spread_to`` deals the rows of too few files to that many partitions, at
    the price of a shuffle. It is the caller's choice: the plan does not depend
    on the number of files."""
    form = select_form(read_raw_csv(spark, path, multi_line), spec)
    return form.repartition(spread_to) if spread_to else form


def write_form_csv(df: DataFrame, path: str, spec: FormSpec, mode: str = "overwrite") -> None:
    """Write renamed raw columns back under the form's CSV headers, in the
    frame's column order; other columns keep their names. Values are kept
    byte for byte: no trimming, quotes doubled."""
    header = {s.name: s.header for s in spec.sources}
    out = df.select(*[F.col(c).alias(header.get(c, c)) for c in df.columns])
    (
        out.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
