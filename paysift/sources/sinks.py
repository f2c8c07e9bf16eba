"""Sinks: reports (S2) and the audit table of rejected rows (S5, X1). Landings are written by ``operators.clean.land``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Overwrite ``path`` with a report. ``single_file`` is for bounded
    reports (top-k); row-per-input reports are written by all tasks."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_audit(rejected: DataFrame, path: str) -> None:
    """Rejected rows with their reasons, as Parquet (the array stays an array). A
    landed form needs no such copy: its ``status=rejected`` folder is the audit table."""
    rejected.write.mode("overwrite").parquet(path)
