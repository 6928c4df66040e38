"""Folders for what a run writes between its stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, root: str | None = None) -> str:
    """A new folder below root or spark.checkpoint.dir, which executors and driver share.

    Only a session on this machine alone may lack both: then it lies in the machine's temporary folder.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"
