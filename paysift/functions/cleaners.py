"""Composed survey cleaners, one Column expression each.

Each cleaner returns cleaned *text*; casting to the target type is a separate
step (``paysift.functions.casts``) so a failed cast can be routed or raised.
Step order follows the survey forms' rules; steps that can never change a
value (they run after letters are rejected or spaces removed) are left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paysift.functions.text import (
    ColumnOrName,
    after_last,
    before,
    blank_if_numeric,
    col_of,
    delete_chars,
    range_bounds,
)

# Characters each money cleaner deletes, per form and column.
MONEY_A_DELETE = "[$£~, ]"
MONEY_C_BASE_DELETE = "[$€£, ]"
MONEY_C_SIGNING_DELETE = "$,"
MONEY_C_ANNUAL_DELETE = "£$,"


def money_a(c: ColumnOrName) -> Column:
    """Form A salary: keep the text before ``(``, then drop ``$ £ ~ ,`` and spaces."""
    return F.regexp_replace(before(c, "("), MONEY_A_DELETE, "")


def money_c_base(c: ColumnOrName) -> Column:
    """Form C base pay: drop ``$ € £ ,`` and spaces."""
    return F.regexp_replace(col_of(c), MONEY_C_BASE_DELETE, "")


def money_c_signing(c: ColumnOrName) -> Column:
    return delete_chars(c, MONEY_C_SIGNING_DELETE)


def money_c_annual(c: ColumnOrName) -> Column:
    return delete_chars(c, MONEY_C_ANNUAL_DELETE)


def experience_a(c: ColumnOrName) -> tuple[Column, Column]:
    """Form A experience ``8 - 10 years`` -> (8, 10); ``1 year or less`` -> (1, 1)."""
    text = before(F.replace(col_of(c), F.lit(" - "), F.lit("-")), " y")
    return range_bounds(text)


def range_plus(c: ColumnOrName) -> tuple[Column, Column]:
    """Form B ranges: drop spaces and ``+``; ``40+`` -> (40, 40); ``40-50`` -> (40, 50)."""
    return range_bounds(delete_chars(c, " +"))


def vacation_text(c: ColumnOrName) -> Column:
    """Form B vacation: ``4+`` -> ``4`` (cast later with truncation)."""
    return F.replace(col_of(c), F.lit("+"), F.lit(""))


def location_a(c: ColumnOrName) -> Column:
    """Form A location: ``/`` -> ``_``, commas and spaces removed, lower case,
    text before ``(``. ``London, UK`` -> ``londonuk``."""
    return before(F.lower(F.translate(col_of(c), "/, ", "_")), "(")


def location_b(city: ColumnOrName, country: ColumnOrName) -> Column:
    """Form B location from (city, country): ``city_country`` lower case,
    ``country`` alone when the city is blank, '' when both are; then spaces
    and commas removed and the text before ``(`` kept."""
    city, country = col_of(city), col_of(country)
    merged = (
        F.when((city == "") & (country == ""), F.lit(""))
        .when(city == "", F.lower(country))
        .otherwise(F.lower(F.concat(city, F.lit("_"), country)))
    )
    return before(delete_chars(merged, " ,"), "(")


def industry_b(c: ColumnOrName) -> Column:
    """Form B industry: upper case, `` - `` -> ``-``, ``/`` -> ``-``."""
    up = F.upper(col_of(c))
    return F.replace(F.replace(up, F.lit(" - "), F.lit("-")), F.lit("/"), F.lit("-"))


def gender_c(c: ColumnOrName) -> Column:
    """MALE / FEMALE in any case and padding; everything else OTHER."""
    g = F.upper(F.trim(col_of(c)))
    return F.when(g.isin("MALE", "FEMALE"), g).otherwise(F.lit("OTHER"))


def experience_c(c: ColumnOrName) -> Column:
    """Form C experience to one number as text: ``<`` and ``+`` dropped, the
    text before the first space kept, and a range keeps its upper bound. A dash
    that is not between numbers ends or opens the number.
    ``< 1`` -> 1, ``10+ years`` -> 10, ``5-10`` -> 10, ``-2`` -> 2, ``3-`` -> 3, ``7 - I think`` -> 7."""
    bare = F.trim(delete_chars(c, "<+"))
    joined = F.regexp_replace(bare, r"([0-9.]) *- *(?=[0-9.])", "$1-")
    return after_last(F.btrim(before(joined, " "), F.lit("-")), "-")


def location_c(c: ColumnOrName) -> Column:
    """Form C location: commas and ``;`` -> ``_``, spaces removed, lower case;
    an all-digit value (a zip code) becomes ''."""
    return blank_if_numeric(F.lower(F.translate(col_of(c), ",; ", "__")))
