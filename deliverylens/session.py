"""Shared storage: where lineage is cut and stage tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, from ``spark.checkpoint.dir``.

    A temporary folder is used only where the session names none and runs in
    local mode, as in tests.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="deliverylens-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, unique to this call."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/deliverylens-{app}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows.

    Needed where later steps must see the same partition numbers, which a
    recomputed range partitioning does not promise.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job started inside are dropped when it ends, not when the driver happens to collect its garbage.

    For tables that are read back from where they were written, and their checks.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
