"""The five reports kept up to date as batches land, from mergeable partial states.

Each landed batch is reduced to the states of its keys: sum, count, minimum and
maximum, whatever the report needs. States add up, so a report is a small
aggregate over all batches' states, not a new pass over all rows. A batch's
states are a folder of its own that a replay overwrites, so a batch counts once
however often it is run. :func:`compact` folds old batches into one folder.
The cash report lists every row; its state is the batch's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.operators.reports import ROLE_KEYWORDS, cash_vs_other, contains_any
from paysift.sources.publish import _fs

#: Report -> (key, state columns as (name, aggregate that makes it, column it reads, aggregate that merges it)).
_SUM, _MIN, _MAX, _COUNT = "sum", "min", "max", "count"
STATES = {
    "role_compensation": ("Job_Title", (("total", _SUM, "Salary"), ("n", _COUNT, "Salary"))),
    "location_compensation": ("Location", (("total", _SUM, "Salary"), ("n", _COUNT, "Salary"), ("low", _MIN, "Salary"), ("high", _MAX, "Salary"))),
    "top_happy_industries": ("Industry", (("n", _COUNT, "Happy_With_Job"),)),
    "top_hour_companies": ("Company_Name", (("high", _MAX, "Max_Actual_Hours_Per_Week"),)),
}
REPORTS = (*STATES, "cash_vs_other")
_MAKE = {_SUM: F.try_sum, _MIN: F.min, _MAX: F.max, _COUNT: F.count}
_MERGE = {_SUM: F.try_sum, _MIN: F.min, _MAX: F.max, _COUNT: F.sum}


def _rows_of(unified: DataFrame, report: str, keywords: Sequence[str]) -> DataFrame:
    if report == "role_compensation":
        return unified.where(contains_any("Job_Title", keywords))
    if report == "top_happy_industries":
        return unified.where(F.col("Happy_With_Job") == "YES")
    if report == "top_hour_companies":
        return unified.where(F.col("Company_Name") != "")
    return unified


def partial_state(unified: DataFrame, report: str, keywords: Sequence[str] = ROLE_KEYWORDS) -> DataFrame:
    """The state of one batch of unified rows for one report."""
    if report == "cash_vs_other":
        return cash_vs_other(unified)
    key, columns = STATES[report]
    rows = _rows_of(unified, report, keywords)
    # a sum that overflows is null, and so must every sum be that it is merged into
    return rows.groupBy(key).agg(*[_MAKE[kind](of).alias(name) for name, kind, of in columns])


def merge_states(states: DataFrame, report: str) -> DataFrame:
    """States of several batches as one; the same shape as a batch's."""
    if report == "cash_vs_other":
        return states
    key, columns = STATES[report]
    return states.groupBy(key).agg(*[_merged(name, kind).alias(name) for name, kind, _ in columns])


def _merged(name: str, kind: str) -> Column:
    if kind != _SUM:
        return _MERGE[kind](name)
    lost = F.count_if(F.col(name).isNull() & (F.col("n") > 0))  # a batch's sum overflowed
    return F.when(lost == 0, F.try_sum(name))


def finish(states: DataFrame, report: str) -> DataFrame:
    """The report of merged states; equal to the report over all rows."""
    mean = F.round(F.try_divide(F.col("total"), F.col("n").cast("decimal(20,0)")), 2) if report in ("role_compensation", "location_compensation") else None
    if report == "role_compensation":
        return states.select("Job_Title", mean.alias("Compensation"))
    if report == "location_compensation":
        return states.select("Location", mean.alias("Average_Compensation"), F.round("low", 2).alias("Min_Compensation"), F.round("high", 2).alias("Max_Compensation"))
    if report == "top_happy_industries":
        top = states.select("Industry", F.col("n").alias("happy_counts"))
        return top.orderBy(F.col("happy_counts").desc_nulls_last(), F.col("Industry").asc_nulls_last()).limit(5)
    if report == "top_hour_companies":
        top = states.select("Company_Name", F.col("high").alias("actual_max_number_of_hours"))
        return top.orderBy(F.col("actual_max_number_of_hours").desc_nulls_last(), F.col("Company_Name").asc_nulls_last()).limit(4)
    return states


def write_states(unified: DataFrame, out: str, batch_id: int, keywords: Sequence[str] = ROLE_KEYWORDS) -> None:
    """Write the states of batch ``batch_id``; a replay of the batch replaces them."""
    for report in REPORTS:
        partial_state(unified, report, keywords).write.mode("overwrite").parquet(f"{out}/{report}/batch={batch_id}")


def _folders(spark: SparkSession, out: str, report: str) -> list[str]:
    """The newest compacted folder and all later batches; earlier ones are part of it."""
    fs, folder = _fs(spark, f"{out}/{report}")
    if not fs.exists(folder):
        return []
    found: dict[str, list[int]] = {"upto": [], "batch": []}
    for status in fs.listStatus(folder):
        kind, _, number = status.getPath().getName().partition("=")
        if kind in found and number.isdigit() and fs.exists(_fs(spark, f"{out}/{report}/{kind}={number}/_SUCCESS")[1]):
            found[kind].append(int(number))
    upto = max(found["upto"], default=-1)
    old = [f"{out}/{report}/upto={upto}"] if upto >= 0 else []
    return old + [f"{out}/{report}/batch={b}" for b in sorted(found["batch"]) if b > upto]


def live_state(spark: SparkSession, out: str | Sequence[str], report: str) -> DataFrame:
    """The merged state of all batches so far, of one folder of states or of several
    (a stream per form, say). Raises if there is none."""
    folders = [f for o in ([out] if isinstance(out, str) else out) for f in _folders(spark, o, report)]
    if not folders:
        raise FileNotFoundError(f"no state of {report} under {out}")
    return merge_states(reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders]), report)


def live_report(spark: SparkSession, out: str | Sequence[str], report: str) -> DataFrame:
    return finish(live_state(spark, out, report), report)


def compact(spark: SparkSession, out: str, upto: int) -> None:
    """Fold batches up to ``upto`` into one folder per report. Batches must have ended; one
    that is replayed later is ignored. A folder counts once it is whole (its _SUCCESS file)."""
    for report in REPORTS:
        folders = [f for f in _folders(spark, out, report) if "/batch=" not in f or int(f.rsplit("=", 1)[1]) <= upto]
        if folders:
            old = reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders])
            merge_states(old, report).write.mode("overwrite").parquet(f"{out}/{report}/upto={upto}")
