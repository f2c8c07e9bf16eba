"""Whole-or-nothing publishing of tables over plain files.

An overwrite deletes the old report before the new one stands. Here, each
publication writes its tables to folders of its own; a small numbered pointer
file that names them is written last, and readers follow the highest pointer
that is complete. A job that dies midway leaves the old publication as it was,
and the rest of its folders is what :func:`vacuum` takes away.

Pointers are never overwritten and nothing is renamed, so the scheme holds on
object stores as well: a pointer is one small object. Two jobs that publish at
the same time both try for the next number; the one that comes second fails
where the store refuses to create an existing file (HDFS, local).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTERS, VERSIONS = "_pointers", "versions"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def pointers(spark: SparkSession, base: str) -> list[tuple[int, dict[str, str]]]:
    """(number, table name -> folder relative to ``base``) of each complete publication, newest first."""
    fs, folder = _fs(spark, f"{base}/{POINTERS}")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".json") and name[:-5].isdigit():
            stream = fs.open(status.getPath())
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                out.append((int(name[:-5]), json.loads(text)))
            except json.JSONDecodeError:  # a writer died within this file: it never counted
                continue
    return sorted(out, key=lambda p: p[0], reverse=True)


def current(spark: SparkSession, base: str) -> dict[str, str]:
    """Table name -> folder of the newest publication; empty if there is none."""
    found = pointers(spark, base)
    return {name: f"{base}/{folder}" for name, folder in found[0][1].items()} if found else {}


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def new_version(base: str) -> str:
    """A folder that no publication has yet, relative to ``base``."""
    return f"{VERSIONS}/{uuid.uuid4().hex}"


def point(spark: SparkSession, base: str, tables: dict[str, str]) -> int:
    """Make ``tables`` (name -> folder relative to ``base``) the newest publication; its number."""
    found = pointers(spark, base)
    number = found[0][0] + 1 if found else 1
    fs, _ = _fs(spark, base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTERS}/{number:012d}.json")
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(json.dumps(tables, sort_keys=True), "utf-8"))
    finally:
        stream.close()
    return number


def publish(spark: SparkSession, base: str, tables: dict[str, DataFrame], fmt: str = "parquet", one_file: set[str] = frozenset()) -> dict[str, str]:
    """Write all ``tables`` and make them the newest publication; their folders.

    Tables named in ``one_file`` are bounded and written by one task.
    """
    from paysift.sources.sinks import write_report

    version = new_version(base)
    folders = {name: f"{version}/{name}" for name in tables}
    for name, df in tables.items():
        write_report(df, f"{base}/{folders[name]}", fmt, single_file=name in one_file)
    point(spark, base, folders)
    return {name: f"{base}/{folder}" for name, folder in folders.items()}


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete version folders that none of the newest ``keep`` publications names, and the
    older pointers; the number of folders deleted. Not while a job publishes here."""
    found = pointers(spark, base)
    live = {f.split("/")[1] for _, tables in found[: max(keep, 1)] for f in tables.values() if f.startswith(f"{VERSIONS}/")}
    fs, folder = _fs(spark, f"{base}/{VERSIONS}")
    gone = 0
    for number, _ in found[max(keep, 1) :]:
        fs.delete(_fs(spark, f"{base}/{POINTERS}/{number:012d}.json")[1], False)
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            if status.getPath().getName() not in live:
                fs.delete(status.getPath(), True)
                gone += 1
    return gone
