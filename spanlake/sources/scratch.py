"""The folder that the driver and all executors share, for tables that a plan writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path below the folder that spark.checkpoint.dir names; only a local session without one (a test) gets one of its own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
