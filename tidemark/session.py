"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", *, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark. On a cluster, the cluster makes the session."""
    shuffle = "8" if cores == "*" else cores
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.session.timeZone", "UTC")
        # Small inputs are split among the cores by the reader.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "512k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path under the cluster's shared ``spark.checkpoint.dir``.

    Without that setting only a session on one machine, as in tests, gets a folder: executors elsewhere
    would write to their own disks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_folders(spark: SparkSession, most: int = 8) -> Iterator[None]:
    """Writes begun here put rows into up to ``most`` folders as they come, where Spark would sort a whole task by folder first.

    A task that meets more folders sorts the rows that are left.
    """
    before = spark.conf.get(_WRITERS, "0")
    spark.conf.set(_WRITERS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_arrow_batches(spark: SparkSession, most: int = 500) -> Iterator[None]:
    """Streams started and jobs run here hand Python workers at most ``most`` rows at once, where Spark's 10,000 long texts fill them.

    A setting that is smaller stays. Zero or less means no limit to Spark.
    """
    before = spark.conf.get(_ARROW_ROWS)
    if not 0 < int(before) <= most:
        spark.conf.set(_ARROW_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)
