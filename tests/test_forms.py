"""Form goldens: CSV in, good and rejected rows compared whole (FIXTURES §3)."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from paysift import FORM_A, FORM_B, FORM_C, process_form, read_form
from paysift.operators.clean import prepare, tag

HERE = os.path.join(os.path.dirname(__file__), "fixtures")


def T(*a):
    return dt.datetime(*a)


def rows(df, ts_col="Created_At"):
    out = df.withColumn(ts_col, F.col(ts_col).cast("timestamp_ntz")) if ts_col in df.columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def result(spark, name, spec, **kw):
    return process_form(read_form(spark, f"{HERE}/{name}", spec), spec, **kw)


def test_reader_binds_by_header_and_keeps_csv_semantics(spark):
    raw = read_form(spark, f"{HERE}/form_a.csv", FORM_A)
    assert raw.columns == FORM_A.names
    got = {r["Created_At"]: r for r in raw.collect()}
    assert got["4/27/2019 1:02:05"]["Job_Title"] == "Software\nEngineer"  # quoted newline kept
    assert got["4/27/2019 11:22:33"]["Job_Title"] == 'The "Data" Guy'  # "" is a quote
    assert got["4/27/2019 11:22:33"]["Industry"] is None  # empty field is NULL
    short = got["4/28/2019 9:30:00"]
    assert short["Age_Range"] == "45-54" and short["Annual_Salary"] is None  # padded
    assert got["4/28/2019 10:00:00"]["Work_Experience"] == "2 - 4 years"  # long row cut
    assert raw.count() == 7  # empty line skipped


def test_form_a_golden(spark):
    res = result(spark, "form_a.csv", FORM_A)
    assert rows(res.good) == sorted([
        (T(2019, 4, 27, 1, 2, 5), "TECH", "SOFTWARE\nENGINEER", D("55000.00"), "londonuk", 25, 34, 8.0, 10.0),
        (T(2019, 4, 27, 11, 22, 33), "", 'THE "DATA" GUY', D("54600.00"), "boston_ma_usa", None, None, 1.0, 1.0),
        (None, "RETAIL", "PROJECT MANAGER", D("60000.00"), "", None, None, 0.0, 0.0),
        (T(2019, 4, 28, 9, 0, 0), "LUXURY GOODS", "LUXURY BUYER", None, "kölnde", 35, 44, 41.0, 41.0),
        (T(2019, 4, 28, 9, 30, 0), "", "", D("0.00"), "", 45, 54, 0.0, 0.0),
        (T(2019, 4, 28, 10, 0, 0), "FINANCE", "ACCOUNTANT", D("48.50"), "nyc", 18, 24, 2.0, 4.0),
    ], key=repr)
    assert [tuple(r) for r in res.rejected.collect()] == [
        ("01/01/1900 00:00:00", "0", "Health", "nurse", "50k", "New York (NYC), NY", "5-7 years", ["salary_alpha"])
    ]


def test_form_b_golden(spark):
    res = result(spark, "form_b.csv", FORM_B)
    assert rows(res.good) == sorted([
        (T(2019, 4, 27, 1, 2, 5), "ACME", "berlin_germany", "TECH-SAAS", "DATA ENGINEER", D("100000.00"),
         D("5000.00"), 4, "YES", "NO", "MALE", 5.0, 10.0, 40, 40, 40, 50),
        (T(2019, 4, 27, 1, 2, 6), "GLOBEX", "usa", "OIL-GAS", "WEB DEVELOPER", None, D("0.00"), 2, "YES", "NO",
         "OTHER", 40.0, 40.0, 40, 40, 60, 60),
        (T(2019, 4, 27, 1, 2, 9), "HOOLI", "sanjose", "TECH", "ARCHITECT", D("120000.00"), D("0.00"), 0, "YES",
         "NO", "PREFER NOT", 10.0, 20.0, 0, 0, 70, 70),
        (T(2019, 4, 27, 1, 2, 10), "ACME", "berlin_germany", "TECH", "SOFTWARE DEV", D("95000.00"), D("2000.00"),
         5, "YES", "NO", "MALE", 3.0, 3.0, 40, 40, 70, 70),
    ], key=repr)
    rej = {r["Created_At"]: r["reasons"] for r in res.rejected.collect()}
    assert rej == {"4/27/2019 1:02:07": ["salary_alpha"], "4/27/2019 1:02:08": ["bonus_alpha"]}


def test_form_c_golden(spark):
    res = result(spark, "form_c.csv", FORM_C)
    assert rows(res.good) == sorted([
        (T(2019, 4, 27, 1, 2, 5), "HOOLI", "sanfrancisco_ca", "SOFTWARE ENGINEER", 5.0, D("120000.00"),
         D("5000.00"), D("5000.00"), "MALE"),
        (T(2019, 4, 27, 1, 2, 6), "INITECH", "london_uk", "PM", 1.0, D("90000.00"), D("0.00"), D("5000.00"),
         "FEMALE"),
        (T(2019, 4, 27, 1, 2, 10), "GLOBEX", "", "DATA ANALYST", 1.0, None, D("0.00"), D("0.00"), "OTHER"),
    ], key=repr)
    rej = {r["Created_At"]: r["reasons"] for r in res.rejected.collect()}
    assert rej == {
        "4/27/2019 1:02:07": ["annual_bonus_format"],
        "4/27/2019 1:02:08": ["salary_alpha", "annual_bonus_format"],
        "4/27/2019 1:02:09": ["signing_alpha"],
    }


@pytest.mark.parametrize("name,spec", [("form_a.csv", FORM_A), ("form_b.csv", FORM_B), ("form_c.csv", FORM_C)])
def test_rows_are_conserved(spark, name, spec):
    raw = read_form(spark, f"{HERE}/{name}", spec)
    res = process_form(raw, spec)
    assert res.good.count() + res.rejected.count() == raw.count()


def test_good_amounts_have_no_letters(spark):
    raw = read_form(spark, f"{HERE}/form_c.csv", FORM_C)
    tagged = tag(prepare(raw, FORM_C), FORM_C)
    good = tagged.filter(F.size("reasons") == 0)
    assert good.filter(F.col("Annual_Base_Salary").rlike("[A-Za-z]")).count() == 0


def test_quarantine_mode_rejects_unconvertible(spark):
    res = result(spark, "form_b.csv", FORM_B, on_cast_fail="quarantine")
    rej = {r["Created_At"]: r["reasons"] for r in res.rejected.collect()}
    assert rej["4/27/2019 1:02:06"] == ["cast_Base_Salary_2018"]  # $1,000
    assert res.good.count() + res.rejected.count() == 6


def test_raise_mode_fails_on_unconvertible(spark):
    res = result(spark, "form_b.csv", FORM_B, on_cast_fail="raise")
    with pytest.raises(Exception, match="cannot convert Base_Salary_2018"):
        res.good.collect()


def test_mismatched_headers_in_a_directory_fail(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "1.csv").write_text("Timestamp,Employer\n1/1/2019 0:00:00,Acme\n")
    (d / "2.csv").write_text("Employer,Timestamp\nAcme,1/1/2019 0:00:00\n")
    from paysift.sources.csv_forms import read_raw_csv

    with pytest.raises(Exception):
        read_raw_csv(spark, str(d)).collect()


def test_land_to_matches_lazy_routing(spark, tmp_path):
    raw = read_form(spark, f"{HERE}/form_c.csv", FORM_C)
    lazy = process_form(raw, FORM_C)
    landed = process_form(raw, FORM_C, land_to=str(tmp_path / "landed"))
    assert sorted(map(repr, landed.good.collect())) == sorted(map(repr, lazy.good.collect()))
    assert sorted(map(repr, landed.rejected.collect())) == sorted(map(repr, lazy.rejected.collect()))


def test_land_to_with_every_row_rejected(spark, tmp_path):
    raw = read_form(spark, f"{HERE}/form_c.csv", FORM_C).filter(F.col("Annual_Bonus") == "10%")
    res = process_form(raw, FORM_C, land_to=str(tmp_path / "landed"))
    assert res.good.count() == 0 and res.rejected.count() == 1
