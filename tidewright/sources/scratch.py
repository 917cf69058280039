"""Where queries may write: below the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, kind: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints"
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
