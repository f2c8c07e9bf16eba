"""The batch job and the streaming job end to end on the golden CSVs."""

import os
import shutil

from pyspark.sql import functions as F

from paysift import FORM_B, process_form, read_form
from paysift.plans.batch import run_batch
from paysift.streaming.forms import read_stream_output, run_form_stream

HERE = os.path.join(os.path.dirname(__file__), "fixtures")


def test_run_batch(spark, tmp_path):
    inputs = {f: f"{HERE}/form_{f.lower()}.csv" for f in "ABC"}
    out = run_batch(spark, inputs, str(tmp_path / "out"))
    assert spark.read.parquet(out.unified).count() == 13
    audit = spark.read.parquet(out.audit["C"])
    assert audit.count() == 3 and dict(audit.dtypes)["reasons"] == "array<string>"
    happy = spark.read.option("header", True).csv(out.reports["top_happy_industries"]).collect()
    assert [r["Industry"] for r in happy] == ["TECH", "OIL-GAS", "TECH-SAAS"]
    quality = {(r["form"], r["reason"]): int(r["n"]) for r in spark.read.option("header", True).csv(out.quality).collect()}
    assert quality == {("A", "salary_alpha"): 1, ("B", "salary_alpha"): 1, ("B", "bonus_alpha"): 1,
                       ("C", "annual_bonus_format"): 2, ("C", "salary_alpha"): 1, ("C", "signing_alpha"): 1}
    assert len(os.listdir(out.reports["top_hour_companies"])) <= 4  # one part file + markers


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    shutil.copy(f"{HERE}/form_b.csv", src / "part1.csv")
    q = run_form_stream(spark, FORM_B, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    # a second file arrives later; the same checkpoint picks up only the new file
    shutil.copy(f"{HERE}/form_b.csv", src / "part2.csv")
    q = run_form_stream(spark, FORM_B, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    good = read_stream_output(spark, str(tmp_path / "out"), FORM_B, "good")
    batch = process_form(read_form(spark, f"{HERE}/form_b.csv", FORM_B), FORM_B).good
    assert good.count() == 2 * batch.count()
    assert good.distinct().exceptAll(batch).count() == 0
    rejected = read_stream_output(spark, str(tmp_path / "out"), FORM_B, "rejected")
    assert rejected.filter(F.size("reasons") > 0).count() == 4


def test_run_batch_exclude_defaulted(spark, tmp_path):
    inputs = {f: f"{HERE}/form_{f.lower()}.csv" for f in "ABC"}
    out = run_batch(spark, inputs, str(tmp_path / "out"), report_format="parquet", exclude_defaulted=True)
    unified = spark.read.parquet(out.unified)
    assert unified.columns[-1] == "Salary_Defaulted" and unified.count() == 13
    loc = {r["Location"]: r for r in spark.read.parquet(out.reports["location_compensation"]).collect()}
    assert str(loc[""]["Min_Compensation"]) == "60000.00"
