"""Session helpers: a tuned local session for tests/bench, and the shared folder.

Library code never changes a caller's session except to set a checkpoint
directory when none is configured (local runs and tests only).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "paysift") -> SparkSession:
    """Local session used by tests and bench: AQE on, UI off, UTC clock."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # a landing writes good and rejected rows at once instead of sorting each task's rows by status
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        # remove checkpoint files once the checkpointed frame is garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the caller's context and settings, for jobs that write files.

    Cleaning a form is one long expression per column; generated as one method it
    is over the 8,000 bytes of bytecode beyond which the JVM doesn't compile but interprets. Here,
    Spark splits such code into methods that are compiled. The caller's session stays as it is.
    """
    work = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if work.conf.isModifiable(name):
            work.conf.set(name, value)
    work.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    work.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")  # a landing isn't sorted by status
    # some more tasks than cores: nine even ones on eight cores would take as long as sixteen
    tasks = str(3 * spark.sparkContext.defaultParallelism)
    work.conf.set("spark.sql.files.minPartitionNum", tasks)
    work.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionNum", tasks)
    return work


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the storage every executor sees.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the
    cluster names one; otherwise (local runs, tests) creates a scratch folder
    and registers it as the checkpoint dir so later calls agree.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext handle (e.g. a remote session)
        sc = None
    base = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if sc is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="paysift-")
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p.strip('/')}"
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage that goes when the driver's JVM ends."""
    path = shared_dir(spark, name, uuid.uuid4().hex)
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path
