"""Scratch folders for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_workdir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a local temporary folder: on a
    cluster, executors and a restarted driver would not see one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all nodes share")
        shared = tempfile.mkdtemp(prefix="quotelake-")
    return f"{shared.rstrip('/')}/quotelake/{name}-{uuid.uuid4().hex}"
