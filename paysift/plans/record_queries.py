"""Registered queries over quarantine, damaged rows, keyed rules, inexact and dated
dictionaries, live reports, corrections, SQL functions and published reports.

As in ``plans.queries``, each takes (spark, sf_dir) and reads whole tables.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.functions.casts import try_ts
from paysift.functions.cleaners import location_a
from paysift.functions.sql_functions import clean_with_sql
from paysift.operators import live_reports
from paysift.operators.clean import REASONS, prepare, process_form
from paysift.operators.corrections import VERSION, merge, read_merged, return_corrections, unified_rows
from paysift.operators.dictionary import standardise_as_of, standardise_inexact
from paysift.operators.forms import FORM_A, FORM_B, FORM_C, FORMS
from paysift.operators.group_rules import contradicts, duplicate_submission, process_with_groups
from paysift.operators.quarantine import RECORD, amend, long_form, long_quarantine, restore
from paysift.operators.reports import location_compensation
from paysift.operators.unify import unify
from paysift.plans.queries import KEEP, as_ntz, batch_outputs
from paysift.session import scratch_dir, work_session
from paysift.sources.damaged import DAMAGED, LINEAGE, SOURCE_FILE, damage_rules, header_of, read_checked
from paysift.sources.derived import damaged_lines, load_table, raw_form, raw_survey, resubmitted, written_survey
from paysift.sources.publish import current, new_version, publish
from paysift.sources.sinks import write_report


def _joined(c: str = REASONS):
    return F.array_join(c, ",").alias(REASONS)


# ---- quarantine --------------------------------------------------------------------------


def _rejected_forms(spark, sf_dir) -> dict[str, DataFrame]:
    wide = raw_survey(spark, sf_dir)
    return {f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f], KEEP).rejected for f in "ABC"}


def q_quarantine_long(spark, sf_dir):
    """Rejected rows of all forms in one long table; the record map as sorted ``name=answer`` text."""
    long = long_quarantine(_rejected_forms(spark, sf_dir), KEEP)
    entries = F.transform(F.array_sort(F.map_entries(RECORD)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("?"))))
    return long.select("form", "row_id", _joined(), F.array_join(entries, "|").alias(RECORD))


def q_quarantine_restored(spark, sf_dir):
    """The long table's form C rows under form C's columns again; equal to the rejected rows."""
    long = long_quarantine(_rejected_forms(spark, sf_dir), KEEP)
    return restore(long, FORM_C, KEEP).withColumn(REASONS, F.array_join(REASONS, ","))


def q_corrections_merged(spark, sf_dir):
    """Form B's rejects go to the client, every second one comes back with the letters
    of its salary taken out, twice; the unified table holds each row once."""
    base, rows, work = scratch_dir(spark, "corrections"), scratch_dir(spark, "correction_rows"), work_session(spark)
    wide = written_survey(work, sf_dir, f"{rows}/orders")
    result = process_form(raw_form(work, sf_dir, "B", wide), FORM_B, KEEP, land_to=f"{rows}/landed")
    merge(work, base, unified_rows(result.good.withColumn(VERSION, F.lit(0)), FORM_B, KEEP), ["form", *KEEP], buckets=8)
    long = long_form(result.rejected, FORM_B, KEEP)
    salary = F.regexp_replace(F.try_element_at(RECORD, F.lit("Base_Salary_2018")), "[A-Za-z]", "")
    answers = long.where("row_id % 2 = 0").select("form", "row_id", F.lit("Base_Salary_2018").alias("column"), salary.alias("answer"))
    restore(amend(long, answers, KEEP), FORM_B, KEEP).drop(REASONS).withColumn(VERSION, F.lit(1)).write.parquet(f"{rows}/corrected")
    corrected = work.read.parquet(f"{rows}/corrected")
    for _ in range(2):
        return_corrections(work, base, corrected, FORM_B, KEEP)
    return as_ntz(read_merged(spark, base))


# ---- damaged rows ------------------------------------------------------------------------


def q_csv_damaged_rows(spark, sf_dir):
    """CSV lines with too many fields, too few and open quotes reach the quarantine with their file and text."""
    path = scratch_dir(spark, "damaged")
    lines = damaged_lines(spark, sf_dir).repartition("lot").sortWithinPartitions("lot", "place").select("lot", "value")
    lines.write.mode("overwrite").partitionBy("lot").text(path)
    header = header_of(spark, path, multi_line=False)
    header = [c for c in header if c != "lot"]
    raw = read_checked(spark, path, FORM_C, multi_line=False, header=header, keep=("row_id",))
    rejected = process_form(raw, FORM_C, [*KEEP, *LINEAGE], extra_rules=damage_rules(len(header))).rejected
    lot = F.regexp_extract(SOURCE_FILE, "lot=([0-9]+)", 1).cast("int")
    return rejected.select(F.col("row_id").cast("long").alias("row_id"), lot.alias("lot"), _joined(), DAMAGED)


# ---- rules over several rows ---------------------------------------------------------------


def q_duplicate_submissions(spark, sf_dir):
    """Form B with some answers sent again; all but the first are rejected, with the form's own reasons before."""
    raw = resubmitted(raw_form(spark, sf_dir, "B"))
    rejected = process_with_groups(raw, FORM_B, [duplicate_submission(FORM_B, "row_id")], KEEP).rejected
    return rejected.select("row_id", _joined())


def _sex():
    g = F.upper("Gender")
    return F.when(g.isin("MALE", "FEMALE"), g)


def q_contradicting_answers(spark, sf_dir):
    """Form B rows whose gender is not the one that form C's rows of the same time and title agree on."""
    wide = raw_survey(spark, sf_dir)
    other = prepare(raw_form(spark, sf_dir, "C", wide), FORM_C)
    rule = contradicts("contradicts_form_c", lambda: F.concat_ws("|", "Created_At", "Job_Title"), _sex, other)
    return process_with_groups(raw_form(spark, sf_dir, "B", wide), FORM_B, [rule], KEEP).rejected.select("row_id", _joined())


# ---- dictionaries ------------------------------------------------------------------------


def q_location_inexact(spark, sf_dir):
    """Form A locations such as ``franceuk`` meet the dictionary's ``france_uk``, one edit away."""
    good = prepare(raw_form(spark, sf_dir, "A"), FORM_A, KEEP).select("row_id", location_a("Location").alias("Location"))
    entries = load_table(spark, sf_dir, "nation").select(
        F.concat(F.lower(F.translate("n_name", " ", "")), F.lit("_uk")).alias("key"), F.concat("n_name", F.lit("/UK")).alias("value")
    )
    return standardise_inexact(good, entries, on="Location", key="key", value="value", distance=1)


def q_customer_inexact(spark, sf_dir):
    """X3 with two edits over names: supplier names with a letter or two lost meet customer
    names of the same number."""
    raw = load_table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Custmer#"), F.lpad((F.col("s_suppkey") * 7).cast("string"), 8, "0")).alias("name"))
    customers = load_table(spark, sf_dir, "customer").select("c_name", F.col("c_custkey").cast("string").alias("c_custkey"))
    return standardise_inexact(raw, customers, on="name", key="c_name", value="c_custkey", distance=2, out="customer")


def q_priority_as_of(spark, sf_dir):
    """X3 over time: each order takes the priority of its customer's latest dictionary entry not after it."""
    orders = load_table(spark, sf_dir, "orders")
    entries = orders.where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("since"), F.col("o_orderpriority").alias("v"))
    rows = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return standardise_as_of(rows, entries, "o_custkey", "o_orderdate", "k", "v", "since", out="priority")


def q_location_as_of(spark, sf_dir):
    """X3 over time on survey data: clean form B locations take the name that was valid when the answer was given."""
    good = as_ntz(process_form(raw_form(spark, sf_dir, "B"), FORM_B, KEEP).good.select("row_id", "Created_At", "Location"))
    named = load_table(spark, sf_dir, "orders").join(load_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    named = named.join(load_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.concat(F.lower("c_mktsegment"), F.lit("_"), F.lower(F.translate("n_name", " ", "")))
    year = F.year("o_orderdate")
    entries = named.select(key.alias("k"), year.alias("y"), F.concat(F.col("n_name"), F.lit("@"), year.cast("string")).alias("v")).distinct()
    entries = entries.select("k", F.make_date("y", F.lit(7), F.lit(1)).cast("timestamp_ntz").alias("since"), "v")
    return standardise_as_of(good, entries, "Location", "Created_At", "k", "v", "since", out="Name")


# ---- reports that are kept up to date ------------------------------------------------------


@lru_cache(maxsize=4)
def _states(spark: SparkSession, application: str, sf_dir: str) -> str:
    """Three landed batches, the second one replayed, the first one compacted."""
    out, work = scratch_dir(spark, "states"), work_session(spark)
    wide = written_survey(work, sf_dir, f"{out}/rows")
    good = {f: process_form(raw_form(work, sf_dir, f, wide), FORMS[f], KEEP).good for f in "ABC"}
    unify(good, KEEP).withColumn("batch", F.pmod("row_id", F.lit(3))).write.partitionBy("batch").parquet(f"{out}/landed")
    for batch in (0, 1, 2, 1):
        live_reports.write_states(work.read.parquet(f"{out}/landed").where(F.col("batch") == batch), f"{out}/states", batch)
    live_reports.compact(work, f"{out}/states", 0)
    return f"{out}/states"


def _live(report: str):
    def query(spark, sf_dir):
        df = live_reports.live_report(spark, _states(spark, spark.sparkContext.applicationId, sf_dir), report)
        for c in ("Compensation", "Average_Compensation"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c).cast("double"))
        return df

    query.__doc__ = f"{report} from the merged states of three batches, one of them replayed and one compacted."
    return query


# ---- SQL functions, strict casts, sinks --------------------------------------------------


def _sql_form(form: str):
    def query(spark, sf_dir):
        return as_ntz(clean_with_sql(raw_form(spark, sf_dir, form), form, tuple(KEEP)))

    query.__doc__ = f"S4: form {form}'s clean table by one SQL text over the catalogue's functions."
    return query


def q_strict_cast_raise(spark, sf_dir):
    """X4 ``raise``: landed rows of form A whose answers all convert; the job must not fail.
    Rows whose date no calendar has (29 February of a common year) land beside them, with no time."""
    base, work = scratch_dir(spark, "raise"), work_session(spark)
    raw = raw_form(work, sf_dir, "A", written_survey(work, sf_dir, f"{base}/rows"))
    raw = raw.withColumn("Created_At", F.regexp_replace("Created_At", "/97 ", "/1997 ")).withColumn("Annual_Salary", F.concat(F.lit("$"), F.col("row_id").cast("string")))
    converts = F.col("Created_At").isNull() | try_ts(F.trim("Created_At")).isNotNull()
    landed = process_form(raw.where(converts), FORM_A, KEEP, on_cast_fail="raise", land_to=f"{base}/a")
    undated = process_form(raw.where(~converts), FORM_A, KEEP, land_to=f"{base}/undated")
    return as_ntz(landed.good.unionByName(undated.good))


def q_batch_observed(spark, sf_dir):
    """S3: rows per form and reason as counted while the landing was written."""
    return spark.read.parquet(batch_outputs(spark, sf_dir).quality)


def q_batch_audit(spark, sf_dir):
    """The audit table's text of form C, read from the landing."""
    rows = spark.read.parquet(batch_outputs(spark, sf_dir).audit["C"])
    return rows.select(*FORM_C.names, _joined())


def q_batch_report_role(spark, sf_dir):
    r = spark.read.parquet(batch_outputs(spark, sf_dir).reports["role_compensation"])
    return r.withColumn("Compensation", F.col("Compensation").cast("double"))


def q_batch_report_cash(spark, sf_dir):
    return spark.read.parquet(batch_outputs(spark, sf_dir).reports["cash_vs_other"])


def q_batch_report_hours(spark, sf_dir):
    return spark.read.parquet(batch_outputs(spark, sf_dir).reports["top_hour_companies"])


def q_batch_csv_report(spark, sf_dir):
    """The location report published as CSV, read back."""
    base = scratch_dir(spark, "csv_report")
    report = spark.read.parquet(batch_outputs(spark, sf_dir).reports["location_compensation"])
    publish(spark, base, {"location": report}, "csv")
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(current(spark, base)["location"])
    return back.select(F.coalesce("Location", F.lit("")).alias("Location"), F.col("Average_Compensation").cast("double").alias("Average_Compensation"),
                       *[F.col(c).cast("decimal(38,2)").alias(c) for c in ("Min_Compensation", "Max_Compensation")])


def q_published_report(spark, sf_dir):
    """A second publication dies after its first table; readers still have the whole first one."""
    base = scratch_dir(spark, "published")
    wide = raw_survey(spark, sf_dir)
    unified = unify({f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f]).good for f in "ABC"})
    report = location_compensation(unified)
    publish(spark, base, {"location": report})
    write_report(report.limit(1), f"{base}/{new_version(base)}/location", "parquet")
    back = spark.read.parquet(current(spark, base)["location"])
    return back.withColumn("Average_Compensation", F.col("Average_Compensation").cast("double"))


QUERIES = {
    "quarantine_long": q_quarantine_long,
    "quarantine_restored": q_quarantine_restored,
    "corrections_merged": q_corrections_merged,
    "csv_damaged_rows": q_csv_damaged_rows,
    "duplicate_submissions": q_duplicate_submissions,
    "contradicting_answers": q_contradicting_answers,
    "location_inexact": q_location_inexact,
    "customer_inexact": q_customer_inexact,
    "priority_as_of": q_priority_as_of,
    "location_as_of": q_location_as_of,
    "live_report_role": _live("role_compensation"),
    "live_report_location": _live("location_compensation"),
    "live_report_cash": _live("cash_vs_other"),
    "live_report_happy": _live("top_happy_industries"),
    "live_report_hours": _live("top_hour_companies"),
    "form_a_sql": _sql_form("A"),
    "form_b_sql": _sql_form("B"),
    "form_c_sql": _sql_form("C"),
    "strict_cast_raise": q_strict_cast_raise,
    "batch_observed": q_batch_observed,
    "batch_audit": q_batch_audit,
    "batch_report_role": q_batch_report_role,
    "batch_report_cash": q_batch_report_cash,
    "batch_report_hours": q_batch_report_hours,
    "batch_csv_report": q_batch_csv_report,
    "published_report": q_published_report,
}
