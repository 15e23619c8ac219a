"""Lineage cuts that survive executor loss.

``materialize`` writes a frame to the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) with a reliable ``checkpoint()``.  The folder is
read from the session; when the cluster names none, the frame is persisted
(MEMORY_AND_DISK, recomputed from its lineage if an executor is lost).
``localCheckpoint`` is never used: its blocks die with their executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, default: str) -> str:
    """Use the session's checkpoint folder; set ``default`` only when none is
    configured (tests and local runs)."""
    found = checkpoint_dir(spark)
    if found:
        return found
    spark.sparkContext.setCheckpointDir(default)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` (eagerly) for reuse by several jobs."""
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


#: Folders of the open scopes, innermost last.
_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables that are made inside go into one folder, which is
    deleted at the end.  Write or collect the result inside: it reads them."""
    folder = scratch_dir(spark, "scope")
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under the cluster's shared
    checkpoint folder.  Only a local-mode session without one (tests, local
    checks) falls back to a new folder under /tmp; on a cluster a missing
    ``spark.checkpoint.dir`` is an error, never a machine-local path."""
    import tempfile
    import uuid

    base = _scopes[-1] if _scopes else checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for intermediate tables")
        base = tempfile.mkdtemp(prefix="logcube-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
