"""Folders for the layers that registered queries write and read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

PREFIX = "tapewatch"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that `spark.checkpoint.dir` names; nothing is created yet."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/{PREFIX}/{label}-{uuid.uuid4().hex}"
