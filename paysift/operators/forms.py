"""Declarative specs of the three survey forms.

A spec lists, per source column, the CSV header, the short name and the value
that replaces NULL; the reject rules in the order they are tested; and the
output fields as (name, target kind, cleaned-text expression). Everything the
cleaning step does is read from here, so a new form is a new spec.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from paysift.functions import cleaners as C
from paysift.functions.text import has_letter, range_bounds


@dataclass(frozen=True)
class Source:
    header: str
    name: str
    default: str | None


@dataclass(frozen=True)
class Rule:
    """A reject test on prepared (trimmed, defaulted) text; True = reject."""

    name: str
    test: Callable[[], Column]


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # timestamp | money | int | float | string
    text: Callable[[], Column]
    may_be_open: bool = False  # text such as "65 or over" is no number, and no defect


@dataclass(frozen=True)
class FormSpec:
    form: str
    sources: tuple[Source, ...]
    rules: tuple[Rule, ...]
    fields: tuple[Field, ...]
    salary: str = ""  # the source column holding the salary answer

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.sources]

    @property
    def headers(self) -> list[str]:
        return [s.header for s in self.sources]

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]


def _lo(pair: Callable[[], tuple[Column, Column]]) -> Callable[[], Column]:
    return lambda: pair()[0]


def _hi(pair: Callable[[], tuple[Column, Column]]) -> Callable[[], Column]:
    return lambda: pair()[1]


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _upper(name: str) -> Callable[[], Column]:
    return lambda: F.upper(F.col(name))


# The timestamp that stands in for a missing one.
TS_DEFAULT = "01/01/1900 00:00:00"

# Fixed values, form A: (CSV header, name, NULL default) in header order.
FORM_A = FormSpec(
    form="A",
    sources=(
        Source("Timestamp", "Created_At", TS_DEFAULT),
        Source("How old are you?", "Age_Range", "0"),
        Source("What industry do you work in?", "Industry", ""),
        Source("Job title", "Job_Title", ""),
        Source("What is your annual salary?", "Annual_Salary", "0"),
        Source("Where are you located? (City/state/country)", "Location", ""),
        Source(
            "How many years of post-college professional work experience do you have?",
            "Work_Experience",
            "0",
        ),
    ),
    rules=(Rule("salary_alpha", lambda: has_letter("Annual_Salary")),),
    fields=(
        Field("Created_At", "timestamp", _col("Created_At")),
        Field("Industry", "string", _upper("Industry")),
        Field("Job_Title", "string", _upper("Job_Title")),
        Field("Annual_Salary", "money", lambda: C.money_a("Annual_Salary")),
        Field("Location", "string", lambda: C.location_a("Location")),
        Field("Min_Age", "int", _lo(lambda: range_bounds("Age_Range", fill_upper=False)), may_be_open=True),
        Field("Max_Age", "int", _hi(lambda: range_bounds("Age_Range", fill_upper=False)), may_be_open=True),
        Field("Min_Exp", "float", _lo(lambda: C.experience_a("Work_Experience"))),
        Field("Max_Exp", "float", _hi(lambda: C.experience_a("Work_Experience"))),
    ),
    salary="Annual_Salary",
)

# Fixed values, form B: (CSV header, name, NULL default) in header order.
FORM_B = FormSpec(
    form="B",
    sources=(
        Source("Timestamp", "Created_At", TS_DEFAULT),
        Source("Company Name", "Company_Name", ""),
        Source("Primary Location (Country)", "Country", ""),
        Source("Primary Location (City)", "City", ""),
        Source("Industry in company", "Industry", ""),
        Source("Years Experience in Industry", "Work_Exp", "0"),
        Source("Job Title In Company", "Job_Title", ""),
        Source("Required Hours Per Week", "Hours_Per_Week", "0"),
        Source("Actual Hours Per Week", "Actual_Hours_Per_Week", "0"),
        Source("Total Base Salary in 2018 (in USD)", "Base_Salary_2018", "0"),
        Source("Total Bonus in 2018 (cumulative annual value in USD)", "Bonus_2018", "0"),
        Source("Annual Vacation (in Weeks)", "Annual_Vacation_In_Weeks", "0"),
        Source("Are you happy at your current position?", "Happy_With_Job", ""),
        Source("Do you plan to resign in the next 12 months?", "Want_To_Resign", ""),
        Source("Gender", "Gender", "other"),
    ),
    rules=(
        Rule("salary_alpha", lambda: has_letter("Base_Salary_2018")),
        Rule("bonus_alpha", lambda: has_letter("Bonus_2018")),
    ),
    fields=(
        Field("Created_At", "timestamp", _col("Created_At")),
        Field("Company_Name", "string", _upper("Company_Name")),
        Field("Location", "string", lambda: C.location_b("City", "Country")),
        Field("Industry", "string", lambda: C.industry_b("Industry")),
        Field("Job_Title", "string", _upper("Job_Title")),
        Field("Base_Salary_2018", "money", _col("Base_Salary_2018")),
        Field("Bonus_2018", "money", _col("Bonus_2018")),
        Field("Annual_Vacation_In_Weeks", "int", lambda: C.vacation_text("Annual_Vacation_In_Weeks")),
        Field("Happy_With_Job", "string", _upper("Happy_With_Job")),
        Field("Want_To_Resign", "string", _upper("Want_To_Resign")),
        Field("Gender", "string", _upper("Gender")),
        Field("Min_Exp", "float", _lo(lambda: C.range_plus("Work_Exp"))),
        Field("Max_Exp", "float", _hi(lambda: C.range_plus("Work_Exp"))),
        Field("Min_Hours_Per_Week", "int", _lo(lambda: C.range_plus("Hours_Per_Week"))),
        Field("Max_Hours_Per_Week", "int", _hi(lambda: C.range_plus("Hours_Per_Week"))),
        Field("Min_Actual_Hours_Per_Week", "int", _lo(lambda: C.range_plus("Actual_Hours_Per_Week"))),
        Field("Max_Actual_Hours_Per_Week", "int", _hi(lambda: C.range_plus("Actual_Hours_Per_Week"))),
    ),
    salary="Base_Salary_2018",
)

# Fixed values, form C: (CSV header, name, NULL default) in header order.
FORM_C = FormSpec(
    form="C",
    sources=(
        Source("Timestamp", "Created_At", TS_DEFAULT),
        Source("Employer", "Company_Name", ""),
        Source("Location", "Location", ""),
        Source("Job Title", "Job_Title", ""),
        Source("Years of Experience", "Work_Exp", "0"),
        Source("Annual Base Pay", "Annual_Base_Salary", "0"),
        Source("Signing Bonus", "Signing_Bonus", "0"),
        Source("Annual Bonus", "Annual_Bonus", "0"),
        Source("Gender", "Gender", ""),
    ),
    rules=(
        Rule("salary_alpha", lambda: has_letter("Annual_Base_Salary")),
        Rule("signing_alpha", lambda: has_letter("Signing_Bonus")),
        # A letter, '%' or '-' anywhere: the bonus is a rate or a range.
        Rule("annual_bonus_format", lambda: F.col("Annual_Bonus").rlike("[A-Za-z%-]")),
    ),
    fields=(
        Field("Created_At", "timestamp", _col("Created_At")),
        Field("Company_Name", "string", _upper("Company_Name")),
        Field("Location", "string", lambda: C.location_c("Location")),
        Field("Job_Title", "string", _upper("Job_Title")),
        Field("Work_Exp", "float", lambda: C.experience_c("Work_Exp")),
        Field("Annual_Base_Salary", "money", lambda: C.money_c_base("Annual_Base_Salary")),
        Field("Signing_Bonus", "money", lambda: C.money_c_signing("Signing_Bonus")),
        Field("Annual_Bonus", "money", lambda: C.money_c_annual("Annual_Bonus")),
        Field("Gender", "string", lambda: C.gender_c("Gender")),
    ),
    salary="Annual_Base_Salary",
)

FORMS = {"A": FORM_A, "B": FORM_B, "C": FORM_C}
