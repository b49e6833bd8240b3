"""Where jobs put intermediate files, and a scoped cache."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as configured on the session.

    Only a local-mode session without the setting gets a temporary folder; on
    a cluster a missing setting is an error, since a machine-local path would
    be lost with its machine.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    global _local_folder
    _local_folder = _local_folder or tempfile.mkdtemp(prefix="sievewell-")
    return _local_folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder (not created yet)."""
    return f"{shared_folder(spark)}/sievewell/{purpose}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to shared storage and read back: a durable lineage cut.

    Use where two later steps must see the very same rows in spite of lost
    executors.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """CTL1: persist for the duration of a block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
