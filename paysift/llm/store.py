"""Cutting lineage in the cluster's shared folder: reliable checkpoints and written tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's ``spark.checkpoint.dir``; only where it is unset, as
    in local tests, make a folder of our own. A cluster must name a shared one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="paysift-llm-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder; later steps and lost executors read it from there.

    Then lets the driver collect its garbage, so that Spark can delete the
    shuffle files of the steps that this copy replaces.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def table(df: DataFrame) -> DataFrame:
    """Like :func:`checkpoint`, but as Parquet, for tables that are read again
    column by column. The folder goes when the driver's JVM ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    gc.collect()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    _files(spark, folder).deleteOnExit(folder)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def drop(df: DataFrame) -> None:
    """Delete what :func:`table` wrote for ``df``. Only for tables whose readers have all been written themselves."""
    spark = df.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
    _files(spark, folder).delete(folder, True)


def _files(spark: SparkSession, folder):
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
