"""The folder that driver and executors share, for tables that a query writes and reads back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a folder of our own in local mode, which has one machine, and an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: intermediate tables need a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="rollforge-")
        spark.sparkContext.setCheckpointDir(where)
        atexit.register(shutil.rmtree, where, ignore_errors=True)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/rollforge-{name}-{uuid.uuid4().hex}"
