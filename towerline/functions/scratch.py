"""Folders for tables that a query has to write before it can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir), or where
    the session names none, in a new local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="spark-towerline-", dir="/tmp")
    return f"{base}/{name}-{uuid.uuid4().hex}"
