"""Quantiles over time from stored sketches: AGG2, AGG12.

A period's rows are read once, into one KLL sketch for each group; longer
spans are merged from the stored sketches, so that a new day rescans nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size parameter: with it a rank is off by well under ``RANK_ERROR`` of the rows, merged sketches included.
SKETCH_K = 800
RANK_ERROR = 0.01


def sketch_by(df: DataFrame, groups: Sequence[str], value: str | Column, k: int = SKETCH_K) -> DataFrame:
    """One row per group: ``n`` values (NULL and NaN left out) and their ``sketch``, NULL for a group without a value."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    x = F.when(~F.isnan(x), x)
    return df.groupBy(*groups).agg(F.count(x).alias("n"), F.kll_sketch_agg_double(x, k).alias("sketch")).withColumn(
        "sketch", F.when(F.col("n") > 0, F.col("sketch"))
    )


def merge_sketches(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Stored rows of ``sketch_by`` merged to coarser groups; sketches alone are moved, a few kB each."""
    return sketches.where(F.col("n") > 0).groupBy(*groups).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, groups: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(groups, probability, n, value) with a rank within ``RANK_ERROR`` of the wanted one; small groups are exact."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.arrays_zip(wanted.alias("probability"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    spread = sketches.where(F.col("n") > 0).select(*groups, "n", F.explode(pairs).alias("pair"))
    return spread.select(*groups, "pair.probability", "n", "pair.value")


@dataclass(frozen=True)
class SketchStore:
    """A parquet folder of sketches, a partition for each period; a period that comes again replaces its sketches only."""

    path: str
    groups: tuple[str, ...] = ()
    period: str = "period"

    def add(self, df: DataFrame, value: str | Column, k: int = SKETCH_K) -> None:
        """Sketch the periods found in ``df``, whole periods each."""
        rows = sketch_by(df, [self.period, *self.groups], value, k)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.period).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)
