"""Folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}  # by application: a folder made here for want of a shared one


def scratch_root(spark: SparkSession) -> str:
    """The application's folder in the shared one named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share a disk, may do without.
    """
    application = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if application not in _own:
            _own[application] = tempfile.mkdtemp(prefix="paysieve-")
        root = _own[application]
    return f"{root.rstrip('/')}/paysieve-{application}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table that every executor can reach."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of the application; call it when its results are read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
