"""Strict casts, overflow, re-runs of a landing, and literal tables of two cleaners."""

import pytest
from survey_helpers import column_values
from pyspark.sql import functions as F

from paysift.functions.casts import try_int_trunc
from paysift.functions.cleaners import experience_c
from paysift.operators.clean import process_form
from paysift.operators.forms import FORM_A
from paysift.operators.reports import group_stats, keyword_average


def form_a(spark, **answers):
    row = {s.name: None for s in FORM_A.sources} | answers
    return spark.createDataFrame([tuple(row[n] for n in FORM_A.names)], ", ".join(f"{n} string" for n in FORM_A.names))


def test_experience_c_literals(spark):
    table = {"3-": "3", "10 -": "10", "5- years": "5", "7 - I think": "7", "6 -  mostly remote": "6", "5-10": "10", "5 - 10 years": "10", "< 1": "1", "-2": "2", "10+ years": "10", "1 - 2 - 3": "3"}
    assert column_values(spark, list(table), experience_c) == list(table.values())


def test_int_truncation_literals(spark):
    table = {".5": 0, ".": 0, "\t5\t": 5, " 5 ": 5, "2.5": 2, "-2.9": -2, "5.": 5, "": None, "x": None, "1e3": None, "99999999999": None, None: None}
    assert column_values(spark, list(table), try_int_trunc) == list(table.values())


@pytest.mark.parametrize("landed", [False, True])
def test_strict_modes_leave_rejected_rows_and_open_bands_alone(spark, tmp_path, landed):
    to = f"{tmp_path}/landed" if landed else None
    bad = form_a(spark, Annual_Salary="62000 USD", Age_Range="65 or over")
    for mode in ("raise", "quarantine"):
        res = process_form(bad, FORM_A, on_cast_fail=mode, land_to=to)
        assert res.good.count() == 0 and [r["reasons"] for r in res.rejected.collect()] == [["salary_alpha"]]
        fine = process_form(form_a(spark, Annual_Salary="62000", Age_Range="65 or over"), FORM_A, on_cast_fail=mode, land_to=to)
        assert [(r["Min_Age"], r["Max_Age"]) for r in fine.good.collect()] == [(None, None)]


def test_relanding_replaces_all_partitions(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        good, bad = form_a(spark, Annual_Salary="1"), form_a(spark, Annual_Salary="x")
        process_form(good.unionByName(bad), FORM_A, land_to=f"{tmp_path}/l")
        res = process_form(good, FORM_A, land_to=f"{tmp_path}/l")
        assert (res.good.count(), res.rejected.count()) == (1, 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_mean_of_huge_salaries_is_null(spark):
    df = spark.createDataFrame([("DATA", "9" * 36)] * 2, "k string, v string").select("k", F.col("v").cast("decimal(38,2)").alias("v"))
    assert keyword_average(df, "k", "v", ["DATA"], "m").first()["m"] is None
    assert group_stats(df, "k", "v", ("a", "b", "c")).first()["a"] is None


def test_strict_query_keeps_rows_whose_date_no_calendar_has(spark, tmp_path):
    """Year 97 stands for 29 February 1996 in every 89th row; 1997 has no such day."""
    from paysift.plans.record_queries import q_strict_cast_raise

    days = [(89, "1996-02-29"), (178, "1996-02-28"), (3, "1996-02-29"), (97, "1996-01-01"), (None, "1996-01-01")]
    orders = spark.createDataFrame([(k, 1, 10.0, d) for k, d in days], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "BUILDING", 1)], "c_custkey long, c_mktsegment string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "FRANCE")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    got = {r.row_id: r.Created_At and str(r.Created_At.date()) for r in q_strict_cast_raise(spark, str(tmp_path)).collect()}
    assert got == {89: None, 178: "1997-02-28", 3: "1996-02-29", 97: "1900-01-01", None: "1900-01-01"}
