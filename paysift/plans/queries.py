"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or the survey text Spark derives from
them, see ``paysift.sources.derived``) in full. Computed columns carry the
same names as in the oracle SQL (``paysift.plans.oracle``); timestamps are
returned as TIMESTAMP_NTZ (wall-clock, zone-free) and averages as DOUBLE so
both engines produce the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.functions import cleaners as C
from paysift.functions.casts import try_float, try_int_trunc, try_money, try_ts
from paysift.functions.text import range_bounds, trim_or_default
from paysift.operators.clean import DEFAULTED, REASONS, prepare, process_form, reason_counts, tag
from paysift.operators.dictionary import standardise
from paysift.operators.forms import FORM_B, FORM_C, FORMS, Rule
from paysift.operators.reports import (
    cash_vs_other,
    group_stats,
    keyword_average,
    location_compensation,
    role_compensation,
    top_happy_industries,
    top_hour_companies,
    top_k,
)
from paysift.operators.unify import unify
from paysift.plans.batch import BatchOutputs, run_batch
from paysift.session import scratch_dir, work_session
from paysift.sources.csv_forms import form_columns, read_raw_csv, write_form_csv
from paysift.sources.derived import load_table, raw_form, raw_survey, written_survey

Query = Callable[[SparkSession, str], DataFrame]
KEEP = ["row_id"]

# Keywords for the part-name stand-in of the role report.
PART_KEYWORDS = ("BOLT", "GEAR", "RING")


def _wall_clock(ts: Column) -> Column:
    """A timestamp's wall clock in UTC, in any session zone."""
    return F.timestamp_add("SECOND", F.unix_seconds(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def as_ntz(df: DataFrame, name: str = "Created_At") -> DataFrame:
    return df.withColumn(name, _wall_clock(F.col(name)))


def _prepared(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    spec = FORMS[form]
    raw = raw_form(spark, sf_dir, form)
    return raw.select("row_id", *[trim_or_default(s.name, s.default).alias(s.name) for s in spec.sources])


def _result(spark: SparkSession, sf_dir: str, form: str, on_cast_fail: str = "null"):
    return process_form(raw_form(spark, sf_dir, form), FORMS[form], KEEP, on_cast_fail)


def _good_forms(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    wide = raw_survey(spark, sf_dir)
    return {f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f]).good for f in "ABC"}


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(_good_forms(spark, sf_dir))


# ---- column-level cleaners ---------------------------------------------------------------


def q_null_defaults(spark, sf_dir):
    """Trim every answer of form B and default the NULLs."""
    return _prepared(spark, sf_dir, "B")


def q_trim_upper_lower(spark, sf_dir):
    """T1-T3 over part names with padding added."""
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return load_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.trim(padded).alias("trimmed"),
        F.upper(padded).alias("upper_name"),
        F.lower(F.upper("p_name")).alias("lower_name"),
    )


def q_money_clean(spark, sf_dir):
    """A1, C1-C3, K2, T4, T5 on every derived money answer (rejected or not)."""
    w = raw_survey(spark, sf_dir)
    return w.select(
        "row_id",
        try_money(C.money_a(_wide_prepared(w, "salary_a", "A", "Annual_Salary"))).alias("Annual_Salary"),
        try_money(C.money_c_base(_wide_prepared(w, "base_c", "C", "Annual_Base_Salary"))).alias(
            "Annual_Base_Salary"
        ),
        try_money(C.money_c_signing(_wide_prepared(w, "signing_c", "C", "Signing_Bonus"))).alias("Signing_Bonus"),
        try_money(C.money_c_annual(_wide_prepared(w, "annual_bonus_c", "C", "Annual_Bonus"))).alias(
            "Annual_Bonus"
        ),
    )


def q_timestamp_parse(spark, sf_dir):
    """K1: survey timestamp text to a timestamp; bad text is NULL."""
    raw = raw_survey(spark, sf_dir)
    return raw.select(
        "row_id", F.col("created_at").alias("created_text"), _wall_clock(try_ts("created_at")).alias("Created_At")
    )


def q_range_split_dash(spark, sf_dir):
    """T6, K3 on order priorities like ``1-URGENT``."""
    lo, hi = range_bounds("o_orderpriority", fill_upper=False)
    return load_table(spark, sf_dir, "orders").select(
        "o_orderkey", try_int_trunc(lo).alias("priority_code"), hi.alias("priority_name")
    )


def q_age_range_split(spark, sf_dir):
    """A3: age bands to (Min_Age, Max_Age); open bands keep a NULL maximum."""
    p = _prepared(spark, sf_dir, "A")
    lo, hi = range_bounds("Age_Range", fill_upper=False)
    return p.select("row_id", try_int_trunc(lo).alias("Min_Age"), try_int_trunc(hi).alias("Max_Age"))


def q_experience_a(spark, sf_dir):
    """``8 - 10 years`` -> (8, 10), ``1 year or less`` -> (1, 1)."""
    p = _prepared(spark, sf_dir, "A")
    lo, hi = C.experience_a("Work_Experience")
    return p.select("row_id", try_float(lo).alias("Min_Exp"), try_float(hi).alias("Max_Exp"))


def q_range_plus(spark, sf_dir):
    """Ranges with ``+`` and spaces, missing upper bound takes the lower."""
    p = _prepared(spark, sf_dir, "B")
    e_lo, e_hi = C.range_plus("Work_Exp")
    h_lo, h_hi = C.range_plus("Hours_Per_Week")
    a_lo, a_hi = C.range_plus("Actual_Hours_Per_Week")
    return p.select(
        "row_id",
        try_float(e_lo).alias("Min_Exp"), try_float(e_hi).alias("Max_Exp"),
        try_int_trunc(h_lo).alias("Min_Hours_Per_Week"), try_int_trunc(h_hi).alias("Max_Hours_Per_Week"),
        try_int_trunc(a_lo).alias("Min_Actual_Hours_Per_Week"),
        try_int_trunc(a_hi).alias("Max_Actual_Hours_Per_Week"),
    )


def q_location_a(spark, sf_dir):
    return _prepared(spark, sf_dir, "A").select("row_id", C.location_a("Location").alias("Location"))


def q_location_b_merge(spark, sf_dir):
    """City and country merged into one location key."""
    return _prepared(spark, sf_dir, "B").select("row_id", C.location_b("City", "Country").alias("Location"))


def q_location_c(spark, sf_dir):
    """Zip codes and other all-digit locations become ''."""
    return _prepared(spark, sf_dir, "C").select("row_id", C.location_c("Location").alias("Location"))


def q_industry_dash(spark, sf_dir):
    return _prepared(spark, sf_dir, "B").select("row_id", C.industry_b("Industry").alias("Industry"))


def _wide_prepared(wide: DataFrame, column: str, form: str, name: str):
    """A wide derived column trimmed and defaulted as ``name`` of ``form``."""
    default = {s.name: s.default for s in FORMS[form].sources}[name]
    return trim_or_default(wide[column], default)


def q_gender_normalise(spark, sf_dir):
    """N5 (form C) next to the plain upper-casing of form B."""
    wide = raw_survey(spark, sf_dir)
    return wide.select(
        "row_id",
        F.upper(_wide_prepared(wide, "gender_b", "B", "Gender")).alias("Gender_B"),
        C.gender_c(_wide_prepared(wide, "gender_c", "C", "Gender")).alias("Gender_C"),
    )


def q_int_truncating_cast(spark, sf_dir):
    """Vacation weeks, ``4+`` -> 4, ``2.5`` -> 2, ``unlimited`` -> NULL."""
    p = _prepared(spark, sf_dir, "B")
    return p.select(
        "row_id", try_int_trunc(C.vacation_text("Annual_Vacation_In_Weeks")).alias("Annual_Vacation_In_Weeks")
    )


def q_experience_c(spark, sf_dir):
    """One experience number per answer."""
    return _prepared(spark, sf_dir, "C").select("row_id", try_float(C.experience_c("Work_Exp")).alias("Work_Exp"))


# ---- whole forms: clean, reject, route ---------------------------------------------------


def q_form_a_clean(spark, sf_dir):
    return as_ntz(_result(spark, sf_dir, "A").good)


def q_form_b_clean(spark, sf_dir):
    return as_ntz(_result(spark, sf_dir, "B").good)


def q_form_c_clean(spark, sf_dir):
    return as_ntz(_result(spark, sf_dir, "C").good)


def _rejected_text(df: DataFrame) -> DataFrame:
    return df.withColumn(REASONS, F.array_join(REASONS, ","))


def q_form_a_rejected(spark, sf_dir):
    return _rejected_text(_result(spark, sf_dir, "A").rejected)


def q_form_b_rejected(spark, sf_dir):
    return _rejected_text(_result(spark, sf_dir, "B").rejected)


def q_form_c_rejected(spark, sf_dir):
    return _rejected_text(_result(spark, sf_dir, "C").rejected)


def _tagged(spark, sf_dir, form: str, wide=None, on_cast_fail: str = "null", extra_rules=()) -> DataFrame:
    spec = FORMS[form]
    raw = raw_form(spark, sf_dir, form, wide)
    return tag(prepare(raw, spec, KEEP), spec, KEEP, on_cast_fail, extra_rules)


def _all_rejected(spark, sf_dir, first_only: bool) -> DataFrame:
    wide = raw_survey(spark, sf_dir)
    parts = [reason_counts(_tagged(spark, sf_dir, f, wide), f, first_only) for f in "ABC"]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_letter_quarantine_counts(spark, sf_dir):
    """Rejected rows per form and reason."""
    return _all_rejected(spark, sf_dir, first_only=False)


def q_cascade_bucket_counts(spark, sf_dir):
    """rows per first failed test, the bucket of a filter cascade."""
    return _all_rejected(spark, sf_dir, first_only=True)


def q_bonus_format_route(spark, sf_dir):
    """F4, F5 (D2 fixed): every form C row lands in exactly one route."""
    p = _prepared(spark, sf_dir, "C")
    tagged = tag(p, FORM_C, KEEP)
    route = F.when(F.size(REASONS) == 0, F.lit("good")).otherwise(F.lit("rejected"))
    return tagged.select("row_id", "Annual_Bonus", route.alias("route"), F.get(F.col(REASONS), 0).alias("first_reason"))


def q_strict_cast_quarantine(spark, sf_dir):
    """With on_cast_fail='quarantine' a value that does not convert
    rejects its row; counts per reason over all three forms."""
    wide = raw_survey(spark, sf_dir)
    parts = [reason_counts(_tagged(spark, sf_dir, f, wide, "quarantine"), f) for f in "ABC"]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# The extra validation rules of the X2 query.
EXTRA_RULES_B = (
    Rule("happy_unknown", lambda: ~F.upper("Happy_With_Job").isin("YES", "NO", "")),
    Rule("company_blank", lambda: F.col("Company_Name") == ""),
)


def q_validation_rules(spark, sf_dir):
    """User rules appended to the form's own reject tests."""
    return reason_counts(_tagged(spark, sf_dir, "B", extra_rules=EXTRA_RULES_B), "B")


# ---- union and the five reports over the derived survey ---------------------------------


def q_unify_forms(spark, sf_dir):
    wide = raw_survey(spark, sf_dir)
    good = {f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f], KEEP).good for f in "ABC"}
    return as_ntz(unify(good, KEEP))


def q_report_role(spark, sf_dir):
    r = role_compensation(_unified(spark, sf_dir))
    return r.withColumn("Compensation", F.col("Compensation").cast("double"))


def q_report_location(spark, sf_dir):
    r = location_compensation(_unified(spark, sf_dir))
    return r.withColumn("Average_Compensation", F.col("Average_Compensation").cast("double"))


def q_report_location_answered(spark, sf_dir):
    """R2 with D14's option: salaries that were missing (defaulted to 0) left out."""
    wide = raw_survey(spark, sf_dir)
    good = {
        f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f], flag_defaulted=True).good for f in "ABC"
    }
    r = location_compensation(unify(good, keep=[DEFAULTED]), exclude_defaulted=True)
    return r.withColumn("Average_Compensation", F.col("Average_Compensation").cast("double"))


def q_report_cash(spark, sf_dir):
    return cash_vs_other(_unified(spark, sf_dir))


def q_report_happy(spark, sf_dir):
    return top_happy_industries(_unified(spark, sf_dir))


def q_report_hours(spark, sf_dir):
    return top_hour_companies(_unified(spark, sf_dir))


# ---- the report operators on driver tables directly -------------------------------------


def q_role_compensation(spark, sf_dir):
    """R1 operator over part: mean retail price per part name holding a keyword."""
    part = load_table(spark, sf_dir, "part").select(
        F.upper("p_name").alias("Job_Title"), F.col("p_retailprice").cast("decimal(38,2)").alias("Salary")
    )
    r = keyword_average(part, "Job_Title", "Salary", PART_KEYWORDS, "Compensation")
    return r.withColumn("Compensation", F.col("Compensation").cast("double"))


def q_location_compensation(spark, sf_dir):
    """R2 operator over customer balances (negative values included) per nation."""
    cust = load_table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("Location"), F.col("c_acctbal").cast("decimal(38,2)").alias("Salary")
    )
    names = ("Average_Compensation", "Min_Compensation", "Max_Compensation")
    r = group_stats(cust, "Location", "Salary", names)
    return r.withColumn("Average_Compensation", F.col("Average_Compensation").cast("double"))


def q_cash_vs_other(spark, sf_dir):
    """R3 operator over every lineitem."""
    li = load_table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(38,2)").alias("Salary"),
        F.col("l_quantity").cast("decimal(38,2)").alias("Bonus"),
    )
    return cash_vs_other(li)


def q_top5_happy(spark, sf_dir):
    """R4 operator: users with the most purchases."""
    ev = load_table(spark, sf_dir, "events")
    return top_k(ev, "user_id", F.count("event_type"), "happy_counts", 5, where=F.col("event_type") == "purchase")


def q_top4_hours(spark, sf_dir):
    """R5 operator: users with the largest event value, sign-ups left out."""
    ev = load_table(spark, sf_dir, "events")
    return top_k(ev, "user_id", F.max("value"), "actual_max_number_of_hours", 4, where=F.col("event_type") != "signup")


def q_dictionary_standardise(spark, sf_dir):
    """Nation key -> nation name by dictionary; Spark picks the join."""
    cust = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = load_table(spark, sf_dir, "nation")
    return standardise(cust, nation, on="c_nationkey", key="n_nationkey", value="n_name", out="c_nation")


def q_location_dictionary(spark, sf_dir):
    """X3 on survey data: clean form B locations mapped to ``NATION/REGION``
    names; locations without an entry stay as they are."""
    good = _result(spark, sf_dir, "B").good.select("row_id", "Location")
    nation = load_table(spark, sf_dir, "nation")
    region = load_table(spark, sf_dir, "region")
    entries = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.lower("n_name").alias("key"), F.concat_ws("/", "n_name", "r_name").alias("value")
    )
    return standardise(good, entries, on="Location", key="key", value="value", out="Location")


# ---- sources and sinks -------------------------------------------------------------------


def q_csv_round_trip(spark, sf_dir):
    """Form B written as headered CSV (an extra column placed second)
    into the shared folder, then read back by header name."""
    path = scratch_dir(spark, "csv_round_trip")
    raw = raw_form(spark, sf_dir, "B")
    write_form_csv(raw.select(FORM_B.names[0], "row_id", *FORM_B.names[1:]), path, FORM_B)
    back = read_raw_csv(spark, path)
    return back.select(F.col("row_id").cast("bigint").alias("row_id"), *form_columns(FORM_B))


def batch_outputs(spark: SparkSession, sf_dir: str) -> BatchOutputs:
    """The batch job's outputs; run once per session and tables, and read by each ``batch_*`` query."""
    return _batch(spark, spark.sparkContext.applicationId, sf_dir)


@lru_cache(maxsize=4)
def _batch(spark: SparkSession, application: str, sf_dir: str) -> BatchOutputs:
    """The batch job over all three forms: CSV files in the shared folder ->
    landing, audit, quality, unified table and reports. Files are removed when
    the driver's JVM ends."""
    base, work = scratch_dir(spark, "batch"), work_session(spark)
    wide = written_survey(work, sf_dir, f"{base}/rows")
    for f in "ABC":
        raw = raw_form(work, sf_dir, f, wide)
        names = FORMS[f].names
        write_form_csv(raw.select(names[0], "row_id", *names[1:]), f"{base}/in/{f}", FORMS[f])
    return run_batch(work, {f: f"{base}/in/{f}" for f in "ABC"}, f"{base}/out", report_format="parquet")


def q_batch_unified(spark, sf_dir):
    """S1, S5, U1 through the batch job: the unified table."""
    return as_ntz(spark.read.parquet(batch_outputs(spark, sf_dir).unified))


def q_batch_quality(spark, sf_dir):
    """X1 through the batch job: rows per form and reason of the written audit tables."""
    audit = batch_outputs(spark, sf_dir).audit
    parts = [reason_counts(spark.read.parquet(audit[f]), f) for f in "ABC"]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_batch_report_location(spark, sf_dir):
    """S2, R2 through the batch job: the written report."""
    r = spark.read.parquet(batch_outputs(spark, sf_dir).reports["location_compensation"])
    return r.withColumn("Average_Compensation", F.col("Average_Compensation").cast("double"))


def q_batch_report_happy(spark, sf_dir):
    """S2, R4 through the batch job: the written report."""
    return spark.read.parquet(batch_outputs(spark, sf_dir).reports["top_happy_industries"])


def q_stream_form_b(spark, sf_dir):
    """Form B through Structured Streaming: CSV files in a folder -> the
    same tagging -> per-batch landed Parquet; returns the good rows."""
    from paysift.streaming.forms import read_stream_output, run_form_stream

    base = scratch_dir(spark, "stream_form_b")
    raw = raw_form(spark, sf_dir, "B")
    ordered = raw.select(FORM_B.names[0], "row_id", *FORM_B.names[1:])
    write_form_csv(ordered, f"{base}/in", FORM_B)
    q = run_form_stream(spark, FORM_B, f"{base}/in", f"{base}/out", f"{base}/checkpoint", keep=["row_id"])
    q.awaitTermination()
    good = read_stream_output(spark, f"{base}/out", FORM_B, "good", keep=["row_id"])
    return as_ntz(good.withColumn("row_id", F.col("row_id").cast("bigint")))


QUERIES: dict[str, Query] = {
    "batch_unified": q_batch_unified,
    "batch_quality": q_batch_quality,
    "batch_report_location": q_batch_report_location,
    "batch_report_happy": q_batch_report_happy,
    "null_defaults": q_null_defaults,
    "trim_upper_lower": q_trim_upper_lower,
    "money_clean": q_money_clean,
    "timestamp_parse": q_timestamp_parse,
    "range_split_dash": q_range_split_dash,
    "age_range_split": q_age_range_split,
    "experience_a": q_experience_a,
    "range_plus": q_range_plus,
    "location_a": q_location_a,
    "location_b_merge": q_location_b_merge,
    "location_c": q_location_c,
    "industry_dash": q_industry_dash,
    "gender_normalise": q_gender_normalise,
    "int_truncating_cast": q_int_truncating_cast,
    "experience_c": q_experience_c,
    "form_a_clean": q_form_a_clean,
    "form_b_clean": q_form_b_clean,
    "form_c_clean": q_form_c_clean,
    "form_a_rejected": q_form_a_rejected,
    "form_b_rejected": q_form_b_rejected,
    "form_c_rejected": q_form_c_rejected,
    "letter_quarantine_counts": q_letter_quarantine_counts,
    "cascade_bucket_counts": q_cascade_bucket_counts,
    "bonus_format_route": q_bonus_format_route,
    "strict_cast_quarantine": q_strict_cast_quarantine,
    "validation_rules": q_validation_rules,
    "unify_forms": q_unify_forms,
    "report_role": q_report_role,
    "report_location": q_report_location,
    "report_location_answered": q_report_location_answered,
    "report_cash": q_report_cash,
    "report_happy": q_report_happy,
    "report_hours": q_report_hours,
    "role_compensation": q_role_compensation,
    "location_compensation": q_location_compensation,
    "cash_vs_other": q_cash_vs_other,
    "top5_happy": q_top5_happy,
    "top4_hours": q_top4_hours,
    "dictionary_standardise": q_dictionary_standardise,
    "location_dictionary": q_location_dictionary,
    "csv_round_trip": q_csv_round_trip,
    "stream_form_b": q_stream_form_b,
}
