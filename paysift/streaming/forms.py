"""Structured Streaming over a folder that keeps receiving survey CSV files.

The cleaners and reject rules are row-local and stateless, so the stream runs
the very same ``prepare -> tag`` projection as the batch job; no watermark or
state store is needed. Each micro-batch is landed once, split by status, under
``<out>/landed/batch=<id>``. A replayed batch (after a driver or executor
loss) overwrites its own folder, so the output stays exactly-once; progress
lives in ``checkpoint_dir``, which must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from paysift.operators.clean import DEFAULTED, REASONS, TYPED, counted_reasons, land, prepare, reason_names, route_landed, tag
from paysift.operators.forms import FormSpec, Rule
from paysift.operators.live_reports import write_states
from paysift.operators.unify import to_unified
from paysift.sources.csv_forms import form_columns


def header_schema(spark: SparkSession, source_dir: str) -> StructType:
    """All-string schema from the CSV header (a streaming source needs one
    up front; CSV binds by position, so it must list every column)."""
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(source_dir).columns
    return StructType([StructField(n, StringType()) for n in names])


def run_form_stream(
    spark: SparkSession,
    spec: FormSpec,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    keep: Sequence[str] = (),
    schema: StructType | None = None,
    on_cast_fail: str = "null",
    extra_rules: Sequence[Rule] = (),
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    flag_defaulted: bool = False,
    states_dir: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    Besides its landing, each batch leaves the reject counts that were observed
    while it was written, under ``<out>/quality/batch=<id>``, and with ``states_dir`` its
    part of the five reports (see ``operators.live_reports``). ``flag_defaulted``
    adds ``Salary_Defaulted`` to the kept columns.
    """
    reader = (
        spark.readStream.schema(schema or header_schema(spark, source_dir))
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", False)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)
    raw = stream.select(*keep, *form_columns(spec))
    prepared = prepare(raw, spec, keep, flag_defaulted)
    kept = [*keep, DEFAULTED] if flag_defaulted else list(keep)
    tagged = tag(prepared, spec, kept, on_cast_fail, extra_rules)

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        path, session = f"{out_dir}/landed/batch={batch_id}", batch.sparkSession
        counts = land(batch, path, spec.names, reason_names(spec, on_cast_fail, extra_rules))
        counted_reasons(session, {spec.form: counts}).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/quality/batch={batch_id}")
        if states_dir is not None:
            good = route_landed(session, path, spec, schema=batch.schema).good
            write_states(to_unified(good, spec.form), states_dir, batch_id)

    writer = tagged.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_stream_output(
    spark: SparkSession, out_dir: str, spec: FormSpec, status: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Good rows (typed fields) or rejected rows (text + reasons) landed so far."""
    landed = spark.read.option("mergeSchema", False).parquet(f"{out_dir}/landed").filter(F.col("status") == status)
    if status == "good":
        return landed.select(*keep, *[F.col(TYPED + n).alias(n) for n in spec.field_names])
    return landed.select(*keep, *spec.names, REASONS)


def read_stream_quality(spark: SparkSession, out_dir: str) -> DataFrame:
    """(form, reason, n) over all batches so far, from what was counted at their landing."""
    return spark.read.parquet(f"{out_dir}/quality").groupBy("form", "reason").agg(F.sum("n").alias("n"))
