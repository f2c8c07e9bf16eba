"""The five reports (R1-R5) and the generic operators under them.

All aggregates are algebraic (avg, min, max, count), so Spark runs them as a
partial aggregate before the shuffle and a final one after: a key that holds a
third of all rows still sends one row per task across the network. Top-k
reports end in ``orderBy().limit()``, which plans as TakeOrderedAndProject
(k rows per partition, then a k-row merge); ties break on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysift.functions.text import ColumnOrName, col_of

# The role keywords, upper case because titles are upper-cased.
ROLE_KEYWORDS = (
    "SOFTWARE", "DATA", "TECH", "ENGINEERING", "WEB", "DEVELOPER", "UX", "PROJECT MANAGER", "FULL STACK",
    "ARCHITECT",
)


def contains_any(c: ColumnOrName, keywords: Sequence[str]) -> Column:
    """Case-sensitive substring test against a keyword list (OR-reduced)."""
    x = col_of(c)
    return reduce(or_, [x.contains(k) for k in keywords])


def keyword_average(df: DataFrame, key: str, value: str, keywords: Sequence[str], out: str) -> DataFrame:
    """Rows whose ``key`` holds any keyword; mean of ``value`` per key, 2 places."""
    return df.filter(contains_any(key, keywords)).groupBy(key).agg(F.round(F.try_avg(value), 2).alias(out))


def group_stats(df: DataFrame, key: str, value: str, names: tuple[str, str, str]) -> DataFrame:
    """Mean, min and max of ``value`` per ``key``, each rounded to 2 places."""
    avg_name, min_name, max_name = names
    return df.groupBy(key).agg(
        F.round(F.try_avg(value), 2).alias(avg_name),
        F.round(F.min(value), 2).alias(min_name),
        F.round(F.max(value), 2).alias(max_name),
    )


def top_k(df: DataFrame, key: str, metric: Column, out: str, k: int, where: Column | None = None) -> DataFrame:
    """The ``k`` keys with the largest aggregate ``metric`` (NULLs last, ties by key)."""
    src = df if where is None else df.filter(where)
    agg = src.groupBy(key).agg(metric.alias(out))
    return agg.orderBy(F.col(out).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


# ---- the survey reports over the unified table -------------------------------------------


def _answered(unified: DataFrame, exclude_defaulted: bool) -> DataFrame:
    """Leave out salaries that were missing and defaulted to 0 (needs the
    ``Salary_Defaulted`` flag from ``process_form(..., flag_defaulted=True)``)."""
    return unified.filter(~F.col("Salary_Defaulted")) if exclude_defaulted else unified


def role_compensation(
    unified: DataFrame, keywords: Sequence[str] = ROLE_KEYWORDS, exclude_defaulted: bool = False
) -> DataFrame:
    """Average salary per job title, for titles naming a tech role."""
    return keyword_average(_answered(unified, exclude_defaulted), "Job_Title", "Salary", keywords, "Compensation")


def location_compensation(unified: DataFrame, exclude_defaulted: bool = False) -> DataFrame:
    """R2: average, minimum and maximum salary per location."""
    names = ("Average_Compensation", "Min_Compensation", "Max_Compensation")
    return group_stats(_answered(unified, exclude_defaulted), "Location", "Salary", names)


def cash_vs_other(unified: DataFrame) -> DataFrame:
    """Salary against bonus, every row."""
    return unified.select(
        F.col("Salary").alias("Cash_Compensation"), F.col("Bonus").alias("Other_Forms_Of_Compensation")
    )


def top_happy_industries(unified: DataFrame, k: int = 5) -> DataFrame:
    """Industries with the most people happy in their position."""
    happy = F.col("Happy_With_Job") == "YES"
    return top_k(unified, "Industry", F.count("Happy_With_Job"), "happy_counts", k, where=happy)


def top_hour_companies(unified: DataFrame, k: int = 4) -> DataFrame:
    """Companies with the longest actual weekly hours (blank names left out)."""
    named = F.col("Company_Name") != ""
    metric = F.max("Max_Actual_Hours_Per_Week")
    return top_k(unified, "Company_Name", metric, "actual_max_number_of_hours", k, where=named)
