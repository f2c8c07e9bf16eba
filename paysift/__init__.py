"""paysift: survey cleaning and compensation reports as Spark DataFrame jobs.

Read headered survey CSVs, trim and default every answer, tag rows that fail
validation with reasons (kept for audit, never dropped), clean and cast the
rest with built-in Spark expressions, union the forms into one table and
build five compensation reports. No Python UDFs anywhere.
"""

from paysift.operators.clean import CleanResult, clean, land, prepare, process_form, reason_counts, route, route_landed, tag
from paysift.operators.dictionary import standardise
from paysift.operators.forms import FORM_A, FORM_B, FORM_C, FORMS, Field, FormSpec, Rule, Source
from paysift.operators.reports import (
    ROLE_KEYWORDS,
    cash_vs_other,
    group_stats,
    keyword_average,
    location_compensation,
    role_compensation,
    top_happy_industries,
    top_hour_companies,
    top_k,
)
from paysift.operators.unify import UNIFIED_COLUMNS, to_unified, unify
from paysift.sources.csv_forms import read_form, write_form_csv
from paysift.sources.sinks import write_audit, write_report

__all__ = [
    "CleanResult", "clean", "prepare", "process_form", "reason_counts", "route", "tag", "standardise",
    "FORM_A", "FORM_B", "FORM_C", "FORMS", "Field", "FormSpec", "Rule", "Source",
    "ROLE_KEYWORDS", "cash_vs_other", "group_stats", "keyword_average", "location_compensation",
    "role_compensation", "top_happy_industries", "top_hour_companies", "top_k",
    "UNIFIED_COLUMNS", "to_unified", "unify", "read_form", "write_form_csv",
    "land", "route_landed", "write_audit", "write_report",
]
