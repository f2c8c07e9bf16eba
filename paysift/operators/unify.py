"""Widen each clean form to one 17-column schema and union them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegerType

MONEY = DecimalType(38, 2)

# The unified table's columns, and (in ``_mapping``) what stands for a column that a form lacks.
UNIFIED_COLUMNS = (
    "Created_At", "Company_Name", "Location", "Industry", "Job_Title", "Salary", "Bonus",
    "Annual_Vacation_In_Weeks", "Happy_With_Job", "Want_To_Resign", "Gender", "Min_Exp", "Max_Exp",
    "Min_Hours_Per_Week", "Max_Hours_Per_Week", "Min_Actual_Hours_Per_Week", "Max_Actual_Hours_Per_Week",
)


def _zero_float() -> Column:
    return F.lit(0).cast(FloatType())


def _as_float(name: str) -> Column:
    return F.col(name).cast(FloatType())


def _mapping(form: str) -> dict[str, Column]:
    """Unified column -> expression over the clean table of ``form``."""
    col = F.col
    if form == "A":
        return {
            "Created_At": col("Created_At"), "Company_Name": F.lit(""), "Location": col("Location"),
            "Industry": col("Industry"), "Job_Title": col("Job_Title"), "Salary": col("Annual_Salary"),
            "Bonus": F.lit(0).cast(MONEY), "Annual_Vacation_In_Weeks": F.lit(0).cast(IntegerType()),
            "Happy_With_Job": F.lit(""), "Want_To_Resign": F.lit(""), "Gender": F.lit("OTHER"),
            "Min_Exp": col("Min_Exp"), "Max_Exp": col("Max_Exp"),
            "Min_Hours_Per_Week": _zero_float(), "Max_Hours_Per_Week": _zero_float(),
            "Min_Actual_Hours_Per_Week": _zero_float(), "Max_Actual_Hours_Per_Week": _zero_float(),
        }
    if form == "B":
        return {
            "Created_At": col("Created_At"), "Company_Name": col("Company_Name"), "Location": col("Location"),
            "Industry": col("Industry"), "Job_Title": col("Job_Title"), "Salary": col("Base_Salary_2018"),
            "Bonus": col("Bonus_2018"), "Annual_Vacation_In_Weeks": col("Annual_Vacation_In_Weeks"),
            "Happy_With_Job": col("Happy_With_Job"), "Want_To_Resign": col("Want_To_Resign"),
            "Gender": col("Gender"), "Min_Exp": col("Min_Exp"), "Max_Exp": col("Max_Exp"),
            "Min_Hours_Per_Week": _as_float("Min_Hours_Per_Week"),
            "Max_Hours_Per_Week": _as_float("Max_Hours_Per_Week"),
            "Min_Actual_Hours_Per_Week": _as_float("Min_Actual_Hours_Per_Week"),
            "Max_Actual_Hours_Per_Week": _as_float("Max_Actual_Hours_Per_Week"),
        }
    if form == "C":
        return {
            "Created_At": col("Created_At"), "Company_Name": col("Company_Name"), "Location": col("Location"),
            "Industry": F.lit(""), "Job_Title": col("Job_Title"), "Salary": col("Annual_Base_Salary"),
            "Bonus": col("Annual_Bonus"), "Annual_Vacation_In_Weeks": F.lit(0).cast(IntegerType()),
            "Happy_With_Job": F.lit(""), "Want_To_Resign": F.lit(""), "Gender": col("Gender"),
            "Min_Exp": _zero_float(), "Max_Exp": col("Work_Exp"),
            "Min_Hours_Per_Week": _zero_float(), "Max_Hours_Per_Week": _zero_float(),
            "Min_Actual_Hours_Per_Week": _zero_float(), "Max_Actual_Hours_Per_Week": _zero_float(),
        }
    raise ValueError(f"unknown form {form!r}")


def to_unified(good: DataFrame, form: str, keep: Sequence[str] = ()) -> DataFrame:
    m = _mapping(form)
    return good.select(*keep, *[m[c].alias(c) for c in UNIFIED_COLUMNS])


def unify(frames: dict[str, DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """Bag union (duplicates kept) of the widened clean forms, by column name."""
    widened = [to_unified(df, form, keep) for form, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), widened)
