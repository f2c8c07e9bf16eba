"""R1-R5 semantics over the unified table of the three golden forms."""

import os
from decimal import Decimal as D

import pytest

from paysift import FORMS, process_form, read_form, unify
from paysift.operators.reports import (
    cash_vs_other,
    location_compensation,
    role_compensation,
    top_happy_industries,
    top_hour_companies,
)
from paysift.operators.unify import UNIFIED_COLUMNS

HERE = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture(scope="module")
def unified(spark):
    goods = {f: process_form(read_form(spark, f"{HERE}/form_{f.lower()}.csv", FORMS[f]), FORMS[f]).good for f in "ABC"}
    return unify(goods)


def test_unified_schema_and_count(unified):
    assert tuple(unified.columns) == UNIFIED_COLUMNS
    types = dict(unified.dtypes)
    assert types["Salary"] == "decimal(38,2)" and types["Min_Hours_Per_Week"] == "float"
    assert unified.count() == 6 + 4 + 3


def test_r1_role_keywords(unified):
    got = {r["Job_Title"]: r["Compensation"] for r in role_compensation(unified).collect()}
    assert got == {
        "SOFTWARE\nENGINEER": D("55000.00"), 'THE "DATA" GUY': D("54600.00"), "PROJECT MANAGER": D("60000.00"),
        "LUXURY BUYER": None, "DATA ENGINEER": D("100000.00"), "WEB DEVELOPER": None, "ARCHITECT": D("120000.00"),
        "SOFTWARE DEV": D("95000.00"), "SOFTWARE ENGINEER": D("120000.00"), "DATA ANALYST": None,
    }


def test_r2_location_stats(unified):
    got = {r["Location"]: tuple(r)[1:] for r in location_compensation(unified).collect()}
    assert got["berlin_germany"] == (D("97500.00"), D("95000.00"), D("100000.00"))
    # NULL salaries are ignored; the defaulted 0 counts
    assert got[""] == (D("30000.00"), D("0.00"), D("60000.00"))


def test_r3_one_row_per_unified_row(unified):
    assert cash_vs_other(unified).count() == unified.count()


def test_r4_ties_break_on_key(unified):
    assert [tuple(r) for r in top_happy_industries(unified).collect()] == [
        ("TECH", 2), ("OIL-GAS", 1), ("TECH-SAAS", 1)]


def test_r5_blank_companies_out_and_c_rows_zero(unified):
    assert [tuple(r) for r in top_hour_companies(unified).collect()] == [
        ("ACME", 70.0), ("HOOLI", 70.0), ("GLOBEX", 60.0), ("INITECH", 0.0)]


def test_r2_can_leave_out_defaulted_salaries(spark):
    from paysift.operators.clean import DEFAULTED

    goods = {
        f: process_form(read_form(spark, f"{HERE}/form_{f.lower()}.csv", FORMS[f]), FORMS[f], flag_defaulted=True).good
        for f in "ABC"
    }
    flagged = unify(goods, keep=[DEFAULTED])
    assert flagged.filter(DEFAULTED).count() == 1  # form A's short row had no salary
    kept = {r["Location"]: tuple(r)[1:] for r in location_compensation(flagged).collect()}
    assert kept[""] == (D("30000.00"), D("0.00"), D("60000.00"))  # default: the 0 counts
    got = {r["Location"]: tuple(r)[1:] for r in location_compensation(flagged, exclude_defaulted=True).collect()}
    assert got[""] == (D("60000.00"), D("60000.00"), D("60000.00"))
    assert role_compensation(flagged, exclude_defaulted=True).count() == role_compensation(flagged).count()
