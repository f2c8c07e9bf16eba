"""The cleaners as SQL functions of the session's catalogue, and each form's clean table as one SQL text.

``register_sql_functions`` creates temporary SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN``). Spark puts their bodies into the plan in place of the calls,
so SQL users get the same built-in expressions that the DataFrame API builds, in
generated code, without Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysift.functions.casts import _FRACTION_TEXT, _INT_TEXT, TS_FORMAT
from paysift.functions.cleaners import MONEY_A_DELETE, MONEY_C_ANNUAL_DELETE, MONEY_C_BASE_DELETE, MONEY_C_SIGNING_DELETE
from paysift.operators.forms import FORMS

PREFIX = "paysift_"


def _text(s: str) -> str:
    return "r'" + s + "'"


#: name -> (parameters, type, body); a body may call the functions above it.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "or_default": ("x STRING, d STRING", "STRING", "coalesce(trim(x), d)"),
    "has_letter": ("x STRING", "BOOLEAN", "x rlike '[A-Za-z]'"),
    "to_ts": ("x STRING", "TIMESTAMP", f"try_to_timestamp(concat(x, ' +00:00'), '{TS_FORMAT} XXX')"),
    "to_money": ("x STRING", "DECIMAL(38,2)", "try_cast(x as decimal(38,2))"),
    "to_float": ("x STRING", "FLOAT", "try_cast(x as float)"),
    "to_int": ("x STRING", "INT", f"if(x rlike {_text(_FRACTION_TEXT)}, 0, try_cast(regexp_extract(x, {_text(_INT_TEXT)}, 1) as int))"),
    "range_low": ("x STRING", "STRING", "get(split(x, '-'), 0)"),
    "range_high": ("x STRING", "STRING", "get(split(x, '-'), 1)"),
    "range_high_or_low": ("x STRING", "STRING", "coalesce(get(split(x, '-'), 1), get(split(x, '-'), 0))"),
    "money_a": ("x STRING", "STRING", f"regexp_replace(substring_index(x, '(', 1), '{MONEY_A_DELETE}', '')"),
    "experience_a": ("x STRING", "STRING", "substring_index(replace(x, ' - ', '-'), ' y', 1)"),
    "location_a": ("x STRING", "STRING", "substring_index(lower(translate(x, '/, ', '_')), '(', 1)"),
    "range_b": ("x STRING", "STRING", "translate(x, ' +', '')"),
    "location_b": (
        "city STRING, country STRING",
        "STRING",
        "substring_index(translate(case when city = '' and country = '' then '' when city = '' then lower(country) "
        "else lower(concat(city, '_', country)) end, ' ,', ''), '(', 1)",
    ),
    "industry_b": ("x STRING", "STRING", "replace(replace(upper(x), ' - ', '-'), '/', '-')"),
    "money_c_base": ("x STRING", "STRING", f"regexp_replace(x, '{MONEY_C_BASE_DELETE}', '')"),
    "money_c_signing": ("x STRING", "STRING", f"translate(x, '{MONEY_C_SIGNING_DELETE}', '')"),
    "money_c_annual": ("x STRING", "STRING", f"translate(x, '{MONEY_C_ANNUAL_DELETE}', '')"),
    "gender_c": ("x STRING", "STRING", "if(upper(trim(x)) in ('MALE', 'FEMALE'), upper(trim(x)), 'OTHER')"),
    "experience_c": (
        "x STRING",
        "STRING",
        "substring_index(btrim(substring_index(regexp_replace(trim(translate(x, '<+', '')), "
        "r'([0-9.]) *- *(?=[0-9.])', '$1-'), ' ', 1), '-'), '-', -1)",
    ),
    "location_c": ("x STRING", "STRING", "if(lower(translate(x, ',; ', '__')) rlike '[^0-9]', lower(translate(x, ',; ', '__')), '')"),
}

#: Per form: the clean columns over the prepared answers, and the rows that are kept.
CLEAN_SQL = {
    "A": (
        "paysift_to_ts(Created_At) Created_At, upper(Industry) Industry, upper(Job_Title) Job_Title, "
        "paysift_to_money(paysift_money_a(Annual_Salary)) Annual_Salary, paysift_location_a(Location) Location, "
        "paysift_to_int(paysift_range_low(Age_Range)) Min_Age, paysift_to_int(paysift_range_high(Age_Range)) Max_Age, "
        "paysift_to_float(paysift_range_low(paysift_experience_a(Work_Experience))) Min_Exp, "
        "paysift_to_float(paysift_range_high_or_low(paysift_experience_a(Work_Experience))) Max_Exp",
        "not paysift_has_letter(Annual_Salary)",
    ),
    "B": (
        "paysift_to_ts(Created_At) Created_At, upper(Company_Name) Company_Name, paysift_location_b(City, Country) Location, "
        "paysift_industry_b(Industry) Industry, upper(Job_Title) Job_Title, paysift_to_money(Base_Salary_2018) Base_Salary_2018, "
        "paysift_to_money(Bonus_2018) Bonus_2018, paysift_to_int(replace(Annual_Vacation_In_Weeks, '+', '')) Annual_Vacation_In_Weeks, "
        "upper(Happy_With_Job) Happy_With_Job, upper(Want_To_Resign) Want_To_Resign, upper(Gender) Gender, "
        "paysift_to_float(paysift_range_low(paysift_range_b(Work_Exp))) Min_Exp, "
        "paysift_to_float(paysift_range_high_or_low(paysift_range_b(Work_Exp))) Max_Exp, "
        "paysift_to_int(paysift_range_low(paysift_range_b(Hours_Per_Week))) Min_Hours_Per_Week, "
        "paysift_to_int(paysift_range_high_or_low(paysift_range_b(Hours_Per_Week))) Max_Hours_Per_Week, "
        "paysift_to_int(paysift_range_low(paysift_range_b(Actual_Hours_Per_Week))) Min_Actual_Hours_Per_Week, "
        "paysift_to_int(paysift_range_high_or_low(paysift_range_b(Actual_Hours_Per_Week))) Max_Actual_Hours_Per_Week",
        "not paysift_has_letter(Base_Salary_2018) and not paysift_has_letter(Bonus_2018)",
    ),
    "C": (
        "paysift_to_ts(Created_At) Created_At, upper(Company_Name) Company_Name, paysift_location_c(Location) Location, "
        "upper(Job_Title) Job_Title, paysift_to_float(paysift_experience_c(Work_Exp)) Work_Exp, "
        "paysift_to_money(paysift_money_c_base(Annual_Base_Salary)) Annual_Base_Salary, "
        "paysift_to_money(paysift_money_c_signing(Signing_Bonus)) Signing_Bonus, "
        "paysift_to_money(paysift_money_c_annual(Annual_Bonus)) Annual_Bonus, paysift_gender_c(Gender) Gender",
        "not paysift_has_letter(Annual_Base_Salary) and not paysift_has_letter(Signing_Bonus) and not Annual_Bonus rlike '[A-Za-z%-]'",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the functions in the session's catalogue; their names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {PREFIX}{name}({parameters}) returns {kind} return {body}")
    return [PREFIX + name for name in FUNCTIONS]


def clean_form_sql(form: str, keep: tuple[str, ...] = ()) -> str:
    """SQL text of a form's clean table over ``{answers}``, its renamed raw answers."""
    columns, kept = CLEAN_SQL[form]
    quoted = {s.name: "null" if s.default is None else "'" + s.default.replace("'", "\\'") + "'" for s in FORMS[form].sources}
    prepared = ", ".join(f"paysift_or_default({n}, {d}) {n}" for n, d in quoted.items())
    first = "".join(f"{c}, " for c in keep)
    return f"with prepared as (select {first}{prepared} from {{answers}}) select {first}{columns} from prepared where {kept}"


def clean_with_sql(raw: DataFrame, form: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A form's clean table by one SQL text over the catalogue's functions."""
    spark = raw.sparkSession
    register_sql_functions(spark)
    return spark.sql(clean_form_sql(form, keep), answers=raw)
