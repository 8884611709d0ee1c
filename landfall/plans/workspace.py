"""The folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="landfall-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder named by spark.checkpoint.dir.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/landfall/{purpose}-{uuid.uuid4().hex}"
