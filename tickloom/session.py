"""Session set-up and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", app: str = "tickloom", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting falls back to a temporary folder:
    a machine-local path would not survive the loss of an executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="spark-tickloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder for a written intermediate table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tickloom-{purpose}-{uuid.uuid4().hex}"
