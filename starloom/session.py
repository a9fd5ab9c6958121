"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on: UTC, AQE with skew splitting, Arrow."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # building large expressions is several times faster without per-call origins
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of this machine is used only where the setting is missing and Spark
    runs in local mode; a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-"))
    return context.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused by a later call."""
    return f"{shared_dir(spark)}/starloom/{name}-{uuid.uuid4().hex}"
