"""The batch job: survey CSVs in, audit table, unified table and five reports out.

Plan, per form: one scan of the raw CSV -> trim/default -> tag reasons and
typed fields in one projection -> landed once as Parquet split by status.
Good and rejected rows are partition-pruned reads of that landing, so the
CSV (unsplittable when multi-line) is read exactly once per form. The unified
table is written once; each report is a column-pruned scan of it, so the
reports cost a few narrow Parquet reads instead of re-cleaning the raw data.
Every intermediate is a written table under ``out`` (shared storage), which
also cuts lineage: a lost executor recomputes from the last written table,
not from the CSVs. The landing's rejected folder is the audit table, and the
quality table comes from counts taken while the landing was written, so
rejects are neither written nor read a second time. Reports are published as
a whole: until all stand, readers see those of the last run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from paysift.operators.clean import DEFAULTED, LandedCounts, counted_reasons, process_form, route_landed
from paysift.operators.forms import FORMS, Rule
from paysift.operators.quarantine import long_quarantine
from paysift.operators.reports import (
    ROLE_KEYWORDS,
    cash_vs_other,
    location_compensation,
    role_compensation,
    top_happy_industries,
    top_hour_companies,
)
from paysift.operators.unify import UNIFIED_COLUMNS, unify
from paysift.sources.csv_forms import read_form
from paysift.sources.damaged import LINEAGE, damage_rules, header_of, read_checked
from paysift.sources.publish import publish
from paysift.sources.sinks import write_report

REPORTS = ("role_compensation", "location_compensation", "cash_vs_other", "top_happy_industries",
           "top_hour_companies")
BOUNDED = {"top_happy_industries", "top_hour_companies"}


@dataclass
class BatchOutputs:
    landed: dict[str, str] = field(default_factory=dict)
    audit: dict[str, str] = field(default_factory=dict)
    counts: dict[str, LandedCounts] = field(default_factory=dict)
    quality: str = ""
    unified: str = ""
    reports: dict[str, str] = field(default_factory=dict)


def build_reports(unified: DataFrame, keywords=ROLE_KEYWORDS, exclude_defaulted: bool = False) -> dict[str, DataFrame]:
    return {
        "role_compensation": role_compensation(unified, keywords, exclude_defaulted),
        "location_compensation": location_compensation(unified, exclude_defaulted),
        "cash_vs_other": cash_vs_other(unified),
        "top_happy_industries": top_happy_industries(unified),
        "top_hour_companies": top_hour_companies(unified),
    }


def run_batch(
    spark: SparkSession,
    inputs: dict[str, str],
    out: str,
    on_cast_fail: str = "null",
    extra_rules: dict[str, list[Rule]] | None = None,
    multi_line: bool = True,
    report_format: str = "csv",
    exclude_defaulted: bool = False,
    check_rows: bool = False,
) -> BatchOutputs:
    """``inputs`` maps a form name (A, B, C) to a CSV file or directory.
    ``exclude_defaulted``: R1 and R2 leave out salaries that were missing
    (by default they count as 0); the unified table then carries the
    ``Salary_Defaulted`` flag after its 17 columns. ``check_rows`` rejects damaged
    CSV rows and lands each row's file (see ``sources.damaged``). Reports are
    published under ``out/reports`` (see ``sources.publish``): ``BatchOutputs.reports``
    names this run's folders, ``publish.current`` the newest ones."""
    out = out.rstrip("/")
    res = BatchOutputs()
    goods = {}
    for form, path in inputs.items():
        spec, rules, keep = FORMS[form], list((extra_rules or {}).get(form, ())), []
        if check_rows:
            header = header_of(spark, path, multi_line)
            raw, keep = read_checked(spark, path, spec, multi_line, header), list(LINEAGE)
            rules += damage_rules(len(header))
        else:
            raw = read_form(spark, path, spec, multi_line=multi_line)
        res.landed[form] = f"{out}/landed/form={form}"
        result = process_form(raw, spec, keep, on_cast_fail=on_cast_fail, extra_rules=rules,
                              land_to=res.landed[form], flag_defaulted=exclude_defaulted)
        goods[form] = result.good
        res.counts[form] = result.counts
        res.audit[form] = f"{res.landed[form]}/status=rejected"

    res.quality = f"{out}/quality"
    write_report(counted_reasons(spark, res.counts), res.quality, report_format, single_file=True)

    res.unified = f"{out}/unified"
    flags = [DEFAULTED] if exclude_defaulted else []
    unified_rows = unify(goods, keep=flags)
    unified_rows.select(*UNIFIED_COLUMNS, *flags).write.mode("overwrite").parquet(res.unified)
    unified = spark.read.parquet(res.unified)
    reports = build_reports(unified, exclude_defaulted=exclude_defaulted)
    res.reports = publish(spark, f"{out}/reports", reports, report_format, BOUNDED)
    return res


def quarantine_of(spark: SparkSession, res: BatchOutputs, keep: Sequence[str] = ()) -> DataFrame:
    """All rejected rows of a run as one long table (form, *keep, reasons, record), read from the landings."""
    return long_quarantine({f: route_landed(spark, path, FORMS[f], keep).rejected for f, path in res.landed.items()}, keep)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files paysift.zip paysift/plans/batch.py --form-a PATH --form-b PATH --out DIR``
    (or ``python -m paysift.plans.batch ...`` with a local session)."""
    import argparse

    parser = argparse.ArgumentParser(description="Clean survey forms and build the compensation reports.")
    for f in "abc":
        parser.add_argument(f"--form-{f}", help=f"CSV file or folder of form {f.upper()}")
    parser.add_argument("--out", required=True, help="output folder on shared storage")
    parser.add_argument("--on-cast-fail", default="null", choices=("null", "quarantine", "raise"))
    parser.add_argument("--single-line", action="store_true", help="answers hold no line breaks (splittable scan)")
    parser.add_argument("--report-format", default="csv")
    parser.add_argument("--exclude-defaulted", action="store_true", help="R1/R2 leave out missing salaries")
    parser.add_argument("--check-rows", action="store_true", help="reject damaged CSV rows, land each row's file")
    args = parser.parse_args(argv)
    inputs = {f.upper(): getattr(args, f"form_{f}") for f in "abc" if getattr(args, f"form_{f}")}
    if not inputs:
        parser.error("give at least one of --form-a, --form-b, --form-c")
    builder = SparkSession.builder.appName("paysift-batch").config("spark.sql.session.timeZone", "UTC")
    spark = builder.config("spark.sql.maxConcurrentOutputFileWriters", "4").getOrCreate()
    res = run_batch(spark, inputs, args.out, on_cast_fail=args.on_cast_fail, multi_line=not args.single_line,
                    report_format=args.report_format, exclude_defaulted=args.exclude_defaulted, check_rows=args.check_rows)
    print(res)


if __name__ == "__main__":
    main()
