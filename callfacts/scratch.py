"""Shared scratch folders for staged and derived tables.

On a cluster the shared folder is the one the session names in
``spark.checkpoint.dir`` (HDFS, object store, ...); without it the call fails.
Only under a ``local`` master, as in tests, a folder of our own is made and set
as the checkpoint dir.
Every process writes below its own unique run folder, so runs never clear or
overwrite each other's files.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_RUN_ID = uuid.uuid4().hex[:12]


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="callfacts-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, *parts: str) -> str:
    """``<shared root>/callfacts/<run id>/<parts...>``; unique to this process."""
    return "/".join([shared_root(spark), "callfacts", _RUN_ID, *parts])


def fresh_folder(spark: SparkSession, *parts: str) -> str:
    """A new folder name below the run folder that nothing has used yet."""
    return run_folder(spark, *parts, uuid.uuid4().hex[:8])
