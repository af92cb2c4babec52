"""Where intermediate and result files go: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; a folder of its own only on a local master without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="lumentab-shared-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
