"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "landfall",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the pipeline relies on.

    On a cluster the caller usually owns the session; this helper is for
    scripts, the bench and tests.  AQE stays on so shuffle partitions are
    coalesced and skewed sort-merge joins are split at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


# Files that one task of a partitioned write may hold open: the months of seven years and more.
OPEN_FILES = 100


@contextmanager
def open_files(spark: SparkSession, most: int = OPEN_FILES) -> Iterator[None]:
    """Partitioned writes within it hold one file open per folder that a task meets, instead of sorting its rows first.

    A sort by folder keeps all of a task's rows in memory, or spills them; open
    files hold what is not written yet, encoded.  Beyond ``most`` folders a
    task sorts the rows that remain, so any number of folders is written.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes within it delete their shuffle files when they end.

    Else these stay until the driver happens to collect the plans as garbage:
    a job of many writes holds the shuffles of all of them on disk at once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` / the context's
    checkpoint directory), which on a cluster names storage every executor
    can reach.  Only in local mode, where driver and executors are one
    process, may it be unset: then a fresh temporary folder is registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="landfall-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under :func:`shared_dir` for one run's output."""
    return os.path.join(shared_dir(spark), "landfall", f"{name}-{uuid.uuid4().hex[:12]}")
