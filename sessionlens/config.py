"""Session helpers for local runs (tests, bench) and lineage cutting.

Library operators never create a session: they use the caller's. These
helpers exist for tests, the bench and command-line use.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "sessionlens",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session pinned to UTC with AQE on and the UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local inputs are often one file = one map task; a local shuffle
        # reader after a broadcast-join rewrite would then run everything
        # downstream in that single task. Read shuffles normally instead.
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The configured shared checkpoint folder, if any."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without one (tests, bench) gets a scratch folder, removed when Python ends;
    on a cluster a missing setting returns None and callers ask for it — a
    machine-local folder is never used there."""
    configured = checkpoint_dir(spark)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            return None
        configured = tempfile.mkdtemp(prefix="sessionlens-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(base, name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through Spark's file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new sub-path of the checkpoint folder, for a table that lazy results read.
    It is deleted when Python ends, if its session still runs then."""
    path, context = scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), spark.sparkContext

    def end() -> None:
        if context is SparkContext._active_spark_context:
            delete_path(spark, path)
    atexit.register(end)
    return path
