"""The folder that driver and executors share, for what is computed on the way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the parent of the context's checkpoint folder.

    Where neither is set there is none, and this raises: a folder of the driver's own would be missed by the executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        current = context.getCheckpointDir()
        if not current:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = current.rsplit("/", 1)[0]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/docweave-{uuid.uuid4().hex}/{name}"
