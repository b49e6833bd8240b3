"""Batch sinks: SNK1, SNK2, SNK10."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows per section of the report bundle.
RANKING_ROWS = 5
SECTION_ROWS = 10


def write_single_csv(df: DataFrame, folder: str) -> str:
    """SNK1/CTL2: one CSV file with a header, as the only part file of ``folder``.

    One task writes it, so this is for small results; large ones belong in
    ``write_table``.
    """
    df.coalesce(1).write.option("header", True).mode("overwrite").csv(folder)
    return folder


def write_table(df: DataFrame, folder: str) -> str:
    """Main export: parquet, as many files as the frame has partitions."""
    df.write.mode("overwrite").parquet(folder)
    return folder


def write_ndjson(df: DataFrame, folder: str) -> str:
    """SNK2: one JSON record per line; NULL fields are left out."""
    df.write.mode("overwrite").json(folder)
    return folder


def section(title: str, df: DataFrame, order: Sequence[Column], rows: int | None = SECTION_ROWS) -> DataFrame:
    """LIM2/SNK10: the first rows of a result as (section, position, row_json).

    ``rows`` None takes the whole result, for results of bounded length.
    """
    head = df if rows is None else df.orderBy(*order).limit(rows)
    as_json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return head.select(
        F.lit(title).alias("section"),
        F.row_number().over(W.orderBy(*order)).cast("bigint").alias("position"),
        as_json.alias("row_json"),
    )


def report_bundle(sections: Sequence[DataFrame]) -> DataFrame:
    """SNK10: sections in one tall frame."""
    return reduce(lambda bundle, part: bundle.unionByName(part), sections)
