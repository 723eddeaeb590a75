"""Folders for what a query writes and reads again, and the disk of what it shuffles."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir, which driver and executors share; in local mode a temporary one if that is unset."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir() + "/ledgerline"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run within go with its end, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
