"""Where jobs put checkpoints, intermediate tables and staged files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only by a local master, where
    driver and tasks are one process; on a cluster a missing setting is an error,
    because executors could not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    key = spark.sparkContext.applicationId
    if key not in _local_root:
        _local_root[key] = tempfile.mkdtemp(prefix="quillstream-")
    return _local_root[key]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root (not created yet)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
