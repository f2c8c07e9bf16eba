"""Column -> Column building blocks. Every function returns a built-in Spark
expression (JVM side, whole-stage codegen); none of them is a Python UDF."""

from paysift.functions.casts import TS_FORMAT, to_kind, try_float, try_int_trunc, try_money, try_ts
from paysift.functions.cleaners import (
    experience_a,
    experience_c,
    gender_c,
    industry_b,
    location_a,
    location_b,
    location_c,
    money_a,
    money_c_annual,
    money_c_base,
    money_c_signing,
    range_plus,
    vacation_text,
)
from paysift.functions.text import (
    after_last,
    before,
    blank_if_numeric,
    col_of,
    delete_chars,
    has_letter,
    has_non_digit,
    range_bounds,
    trim_or_default,
)

__all__ = [
    "TS_FORMAT", "to_kind", "try_float", "try_int_trunc", "try_money", "try_ts",
    "experience_a", "experience_c", "gender_c", "industry_b", "location_a", "location_b", "location_c",
    "money_a", "money_c_annual", "money_c_base", "money_c_signing", "range_plus", "vacation_text",
    "after_last", "before", "blank_if_numeric", "col_of", "delete_chars", "has_letter", "has_non_digit",
    "range_bounds", "trim_or_default",
]
