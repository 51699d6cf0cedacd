"""Where a run keeps its tables when no store is named: the folder that the session's executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def temporary_store(spark: SparkSession) -> str:
    """A new store in spark.checkpoint.dir; where that is unset, a folder of this machine serves a local master (tests) only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexgate-")
    return f"{folder.rstrip('/')}/store-{uuid.uuid4().hex}"
