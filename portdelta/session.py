"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split into several tasks at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_root: str | None = None


def build_session(app: str = "portdelta", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings every job of the package expects.

    ``spark.sql.shuffle.partitions`` is left to the cluster (adaptive execution merges small
    partitions); tests pass their own value.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may do without it; it then gets one temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="portdelta-")
    return _local_root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses; what is there goes when the driver ends."""
    path = f"{shared_root(spark)}/portdelta/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
