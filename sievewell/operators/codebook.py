"""Category codes that stay: PRJ27."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell.operators.charts import category_codes
from sievewell.streaming.commits import Folder

CODE_SCHEMA = T.StructType([T.StructField("label", T.StringType()), T.StructField("code", T.LongType())])


def new_codes(known: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """(label, code) of labels that ``known`` does not have, numbered on from its highest code in hash-bucket order."""
    unknown = labels.select(F.col(label).alias("label")).join(known.select("label"), "label", "left_anti")
    following = known.agg((F.coalesce(F.max("code"), F.lit(-1)) + 1).alias("following"))
    return category_codes(unknown, "label").select("label", (F.col("code") + following.scalar()).alias("code"))


@dataclass(frozen=True)
class CodeBook:
    """A folder with a part for each run that met new labels.

    Codes once given never change: a part is only added, and is seen when it
    is complete.  A run that broke off leaves a part that the next one writes
    over.  One writer at a time.  NULL has no code.
    """

    path: str

    def _parts(self, spark: SparkSession) -> list[str]:
        folder = Folder(spark, self.path)
        return [n for n in folder.names() if folder.read(f"{n}/_SUCCESS") is not None]

    def read(self, spark: SparkSession) -> DataFrame:
        """All codes given so far."""
        parts = self._parts(spark)
        if not parts:
            return spark.createDataFrame([], CODE_SCHEMA)
        return spark.read.schema(CODE_SCHEMA).parquet(*[f"{self.path}/{p}" for p in parts])

    def add(self, labels: DataFrame, label: str = "label") -> DataFrame:
        """Give the labels met for the first time the next free codes; returns all codes."""
        spark = labels.sparkSession
        part = f"part-{len(self._parts(spark)):06d}"
        new_codes(self.read(spark), labels, label).write.mode("overwrite").parquet(f"{self.path}/{part}")
        return self.read(spark)
