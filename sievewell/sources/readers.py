"""Batch sources with explicit schemas: SRC1, SRC2, SRC4-SRC7."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell import schemas
from sievewell.streaming.commits import committed_only

# Fixed value: file names of the per-partition reject files; or folders of a batch as Spark writes them.
REJECT_FILE_PATTERN = r"rejected_batch_(\d+)(?:_part_\d+)?\.csv$"
REJECT_FOLDER_PATTERN = r"/rejected_batch[_=](\d+)/[^/]+$"


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_RECORD_SCHEMA) -> DataFrame:
    """SRC1: one JSON record per line (splittable; the form to use at scale)."""
    return spark.read.schema(schema).json(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_RECORD_SCHEMA) -> DataFrame:
    """SRC2: files holding one JSON array of records; each file is one task."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_event_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_EVENT_SCHEMA) -> DataFrame:
    """SRC4: event files as text columns; rows of the wrong width are kept and marked."""
    return csv_options(spark.read.schema(schema)).csv(path)


def csv_options(reader, corrupt: str = schemas.CORRUPT_COLUMN):
    """SRC4: header, permissive parsing and corrupt-row capture, for batch and stream readers.

    Column pruning is off: a parser that skips fields does not notice that a
    row has too many, and the verdict on a row must not depend on which
    columns a query happens to use.
    """
    return (
        reader.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("columnPruning", False)
    )


def read_log_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """SRC5: a log with a header, typed by ``schema``; raises when a required column is missing.

    Columns are taken by name, so their order in the files is free as long as
    all files share it: reading fails on a file with another header.  Columns
    of ``schema`` that are neither required nor in the files come as NULL.
    """
    required = schema.fieldNames() if required is None else list(required)
    path = path if isinstance(path, str) else list(path)
    raw = spark.read.option("header", True).csv(path)
    if not raw.columns:
        return spark.createDataFrame([], schema)
    absent = sorted(set(required) - set(raw.columns))
    if absent:
        raise ValueError(f"{path} lacks column(s) {absent}; its header may be missing or truncated")
    # With ``enforceSchema`` off every file's header is held against the first one's.
    raw = spark.read.schema(raw.schema).option("header", True).option("enforceSchema", False).option("columnPruning", False).csv(path)
    return raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_reject_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC6: reject files under a glob, with the batch id taken from the name of the file or of its folder.

    Files that follow neither pattern are left out.
    """
    place = F.col("_metadata.file_path")
    batch = [F.regexp_extract(place, p, 1).try_cast("bigint") for p in (REJECT_FILE_PATTERN, REJECT_FOLDER_PATTERN)]
    named = spark.read.schema(schema).option("header", True).csv(path).withColumn("batch_id", F.coalesce(*batch))
    return named.filter(F.col("batch_id").isNotNull())


def read_keyed_table(spark: SparkSession, path: str, schema: T.StructType = schemas.SINK_SCHEMA, commits: str | None = None) -> DataFrame:
    """SRC7: the keyed sink table, with its (stream_id, batch_id) partition columns.

    Of a sink with a commit log, pass its path to see committed batches only.
    """
    rows = spark.read.schema(schemas.with_batch_keys(schema)).parquet(path)
    return rows if commits is None else committed_only(rows, commits, "inserted")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """SRC7: the sink table in a database; pass ``partitionColumn`` etc. to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
