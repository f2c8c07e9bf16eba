"""Quarantine of all forms in one long table, and the way back to a form's columns.

The forms' rejected rows have unlike columns (7, 15 and 9 text answers). The
long form gives them one schema: the form, the ordered reasons and the answers
as a map from column name to text. So one table, one sink and one query serve
every form, and a new form needs no new schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysift.operators.clean import REASONS
from paysift.operators.forms import FORMS, FormSpec

FORM, RECORD = "form", "record"


def long_form(rejected: DataFrame, spec: FormSpec, keep: Sequence[str] = ()) -> DataFrame:
    """(form, *keep, reasons array<string>, record map<string,string>) of one form's
    rejected rows. Every answer is in the map, missing ones as null."""
    answers = [x for name in spec.names for x in (F.lit(name), F.col(name))]
    return rejected.select(F.lit(spec.form).alias(FORM), *keep, REASONS, F.create_map(*answers).alias(RECORD))


def long_quarantine(rejected: dict[str, DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """The rejected rows of several forms (form name -> rows) as one table; one row for each."""
    return reduce(DataFrame.unionByName, [long_form(df, FORMS[form], keep) for form, df in rejected.items()])


def restore(long: DataFrame, spec: FormSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The long table's rows of one form under the form's columns again, ready for another round of cleaning."""
    rows = long.where(F.col(FORM) == spec.form)
    return rows.select(*keep, *[F.try_element_at(RECORD, F.lit(n)).alias(n) for n in spec.names], REASONS)


def amend(long: DataFrame, answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The long table's rows that ``answers`` (*keys, form, column, answer) corrects, with the new answers in their records.

    Several corrections of one answer: the largest text counts. A column that
    the form doesn't have is ignored. Corrections of one row are few; they are
    summed up per row before they meet it.
    """
    ids = [FORM, *keys]
    one = answers.groupBy(*ids, "column").agg(F.max("answer").alias("answer"))
    new = one.groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct("column", "answer"))).alias("new"))
    return long.join(new, ids).withColumn(RECORD, F.transform_values(RECORD, lambda k, v: F.coalesce(F.try_element_at("new", k), v))).drop("new")
