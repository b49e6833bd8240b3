"""Durable intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sievewell.plans.scratch import scratch_path


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to shared storage and read back, so that lost executors cost no more than their own tasks."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
