"""Unit tables for the column cleaners and casts (expected values from FIXTURES §3)."""

import datetime as dt
from decimal import Decimal as D

from survey_helpers import column_values
from pyspark.sql import functions as F

from paysift.functions import cleaners as C
from paysift.functions.casts import try_float, try_int_trunc, try_money, try_ts
from paysift.functions.text import has_letter, range_bounds, trim_or_default


def test_money_a(spark):
    vals = ["55,000", "$54,600", "£41 000", "~70,000", "60000 (12,000)", "48.5", "12.345", "-5", "€50000", "70-80", ""]
    exp = [D("55000.00"), D("54600.00"), D("41000.00"), D("70000.00"), D("60000.00"), D("48.50"), D("12.35"),
           D("-5.00"), None, None, None]
    assert column_values(spark, vals, lambda c: try_money(C.money_a(c))) == exp


def test_money_a_letters_are_rejected_and_null_defaults_to_zero(spark):
    assert column_values(spark, ["50k", "62000 USD", "1e5", "55,000"], has_letter) == [True, True, True, False]
    assert column_values(spark, [None], lambda c: try_money(C.money_a(trim_or_default(c, "0")))) == [D("0.00")]


def test_location_a(spark):
    vals = ["London, UK", "Boston/MA/USA", "New York (NYC), NY", " (remote)", "Köln, DE", None]
    exp = ["londonuk", "boston_ma_usa", "newyork", "", "kölnde", ""]
    assert column_values(spark, vals, lambda c: C.location_a(trim_or_default(c, ""))) == exp


def test_age_split(spark):
    vals = ["25-34", "65 or over", "under 18", "0"]
    got = column_values(spark, vals, lambda c: tuple(try_int_trunc(x) for x in range_bounds(c, fill_upper=False)))
    assert got == [(25, 34), (None, None), (None, None), (0, None)]


def test_experience_a(spark):
    vals = ["8 - 10 years", "1 year or less", "41 years or more", "5-7 years", "0"]
    got = column_values(spark, vals, lambda c: tuple(try_float(x) for x in C.experience_a(c)))
    assert got == [(8.0, 10.0), (1.0, 1.0), (41.0, 41.0), (5.0, 7.0), (0.0, 0.0)]


def test_location_b(spark):
    pairs = [("Germany", "Berlin"), ("USA", ""), ("", "Paris"), ("", ""), ("USA", "San Jose (CA), west"),
             ("Korea, South", "Seoul")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, country string, city string")
    got = [r[0] for r in df.orderBy("i").select(C.location_b("city", "country")).collect()]
    assert got == ["berlin_germany", "usa", "paris_", "", "sanjose", "seoul_koreasouth"]


def test_range_plus(spark):
    vals = ["40-50", "40+", "5 - 10", "20", "10-20-30", "-5", "n/a"]
    got = column_values(spark, vals, lambda c: tuple(try_int_trunc(x) for x in C.range_plus(c)))
    assert got == [(40, 50), (40, 40), (5, 10), (20, 20), (10, 20), (None, 5), (None, None)]


def test_industry_b(spark):
    got = column_values(spark, ["Tech - SaaS", "Oil/Gas", "Tech- SaaS"], C.industry_b)
    assert got == ["TECH-SAAS", "OIL-GAS", "TECH- SAAS"]


def test_vacation_truncates(spark):
    got = column_values(spark, ["4+", "3", "2.5", "unlimited", "-2.7", " 6 "], lambda c: try_int_trunc(C.vacation_text(c)))
    assert got == [4, 3, 2, None, -2, 6]


def test_money_c(spark):
    vals = ["$120,000", "€ 90 000", "£50,000", "-1", "100/200"]
    assert column_values(spark, vals, lambda c: try_money(C.money_c_base(c))) == [
        D("120000.00"), D("90000.00"), D("50000.00"), D("-1.00"), None]
    assert column_values(spark, ["$5,000", "0"], lambda c: try_money(C.money_c_signing(c))) == [D("5000.00"), D("0.00")]
    assert column_values(spark, ["£5,000", "5000", "$1,5"], lambda c: try_money(C.money_c_annual(c))) == [
        D("5000.00"), D("5000.00"), D("15.00")]


def test_gender_c(spark):
    vals = ["male", "Female ", "prefer not", "other", "", None]
    got = column_values(spark, vals, lambda c: C.gender_c(trim_or_default(c, "")))
    assert got == ["MALE", "FEMALE", "OTHER", "OTHER", "OTHER", "OTHER"]


def test_experience_c(spark):
    vals = ["5", "<1", "3 years (ML)", "-2", "", "5-10", "10+ years", "< 1", "5 - 10 years"]
    got = column_values(spark, vals, lambda c: try_float(C.experience_c(c)))
    assert got == [5.0, 1.0, 3.0, 2.0, None, 10.0, 10.0, 1.0, 10.0]


def test_location_c(spark):
    vals = ["San Francisco, CA", "London;UK", "NYC", "94105", "12 34", ""]
    got = column_values(spark, vals, C.location_c)
    assert got == ["sanfrancisco_ca", "london_uk", "nyc", "", "", ""]


def test_timestamp(spark):
    vals = ["4/27/2019 1:02:05", "01/01/1900 00:00:00", "2019-04-27", "4/27/19 1:02:05", "13/45/2019 1:02:05",
            "4/7/2019 1:02"]
    got = column_values(spark, vals, lambda c: try_ts(c).cast("timestamp_ntz"))
    assert got == [dt.datetime(2019, 4, 27, 1, 2, 5), dt.datetime(1900, 1, 1), None, None, None, None]


def test_money_cast_rounds_half_up(spark):
    assert column_values(spark, ["12.345", "-12.345", "1,000"], try_money) == [D("12.35"), D("-12.35"), None]


def test_cleaners_are_idempotent_where_defined(spark):
    vals = ["$54,600", "£41 000", "48.5"]
    once = column_values(spark, vals, C.money_a)
    assert column_values(spark, once, C.money_a) == once
    up = column_values(spark, ["Tech - SaaS", "Oil/Gas"], C.industry_b)
    assert column_values(spark, up, C.industry_b) == up
    assert column_values(spark, [" a b "], lambda c: F.trim(F.trim(c))) == ["a b"]
