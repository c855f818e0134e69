"""Session helpers: a local session for tests, and paths every executor can reach."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "millstream", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in `spark.checkpoint.dir`; a private one only in local mode, where all tasks share it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="millstream-")
    # The context remembers the folder; a running session's setting can't be changed.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder, so later reads prune columns and survive lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage durably: see `stored`."""
    return stored(df, "settled")
