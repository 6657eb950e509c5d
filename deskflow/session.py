"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "deskflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of DataFrame methods are not recorded: they cost a driver call per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="deskflow-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver and
    the tasks are one process on one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _run_folder(spark: SparkSession, root: str) -> str:
    """One folder for what this session writes; it goes when the session's file system is closed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/deskflow/{uuid.uuid4().hex}")
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return folder.toString()


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of one job, under the shared root."""
    return f"{_run_folder(spark, shared_root(spark))}/{name}-{uuid.uuid4().hex}"
