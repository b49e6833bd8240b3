"""Run summaries kept by increments: PRF1, AGG8-AGG10, WIN13.

A segment stands for batches of one stream with no pause between them.  It
holds the first batch and sums over the others, so that two segments can be
made one; a later increment of the log is reduced by itself, and a summary
reads segments, never the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievewell.functions import expressions as X
from sievewell.operators.runs import RUN_GAP_SECONDS, assign_runs
from sievewell.plans.skew import salted_lookup

_SUMS = ("received", "inserted", "rejected")


def run_segments(batches: DataFrame, ts: str = "timestamp", gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ("stream_id",), batch: str = "batch_id") -> DataFrame:
    """One row per run of the given batches: its first batch, its bounds, and what the other batches add.

    ``batches`` has a row per batch: ``keys``, batch id, time, received,
    inserted, rejected, batch_duration_ms and processed_rows_per_second.  Rows
    without a time belong to no run.
    """
    kind = dict(batches.dtypes)[ts]
    first = F.struct(
        X.epoch_micros(F.col(ts), kind).alias("us"), F.col(batch).cast("bigint").alias("batch_id"),
        F.col("batch_duration_ms").cast("bigint").alias("ms"), F.col("processed_rows_per_second").cast("double").alias("rate"),
    )
    rows = assign_runs(batches.where(F.col(ts).isNotNull()), ts, gap_seconds=gap_seconds, keys=keys).select(*keys, "run_id", *_SUMS, first.alias("one"))
    run = [*keys, "run_id"]
    firsts = rows.groupBy(*run).agg(F.min("one").alias("first"))
    placed = salted_lookup(rows, firsts, run, ["one"])
    later = F.when(F.col("one") != F.col("first"), F.col("one"))
    return placed.groupBy(*run).agg(
        F.min("first").alias("first"),
        F.max("one.us").alias("last_us"),
        F.count(F.lit(1)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _SUMS],
        *_of_others(later["ms"], later["rate"]),
    ).drop("run_id")


def _of_others(ms, rate):
    return [
        F.count(ms).alias("n_ms"), F.sum(ms).alias("sum_ms"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"),
        F.count(rate).alias("n_rate"), F.sum(rate).alias("sum_rate"),
    ]


def merge_segments(segments: DataFrame, gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ("stream_id",)) -> DataFrame:
    """Segments less than a gap apart made one, in whatever order their batches were logged.

    A stream has few segments: one for each increment and pause.
    """
    in_time = W.partitionBy(*keys).orderBy("first.us", "first.batch_id")
    reached = F.max("last_us").over(in_time.rowsBetween(W.unboundedPreceding, -1))
    gap = int(round(gap_seconds * 1_000_000))
    starts = F.coalesce((F.col("first.us") - reached > gap).cast("int"), F.lit(1))
    numbered = segments.withColumn("__new", starts).withColumn("run_id", F.sum("__new").over(in_time.rowsBetween(W.unboundedPreceding, W.currentRow)))
    own = F.row_number().over(W.partitionBy(*keys, "run_id").orderBy("first.us", "first.batch_id")) == 1
    placed = numbered.withColumn("__own", own)
    # The first batch of every segment but the earliest is one of the others now.
    extra = F.when(~F.col("__own"), F.col("first"))
    zero = F.lit(0)
    return placed.groupBy(*keys, "run_id").agg(
        F.min("first").alias("first"),
        F.max("last_us").alias("last_us"),
        *[F.sum(c).alias(c) for c in ("batches", *_SUMS)],
        (F.sum("n_ms") + F.count(extra["ms"])).alias("n_ms"),
        (F.coalesce(F.sum("sum_ms"), zero) + F.coalesce(F.sum(extra["ms"]), zero)).alias("sum_ms"),
        F.min(F.least("min_ms", extra["ms"])).alias("min_ms"),
        F.max(F.greatest("max_ms", extra["ms"])).alias("max_ms"),
        (F.sum("n_rate") + F.count(extra["rate"])).alias("n_rate"),
        (F.coalesce(F.sum("sum_rate"), zero) + F.coalesce(F.sum(extra["rate"]), zero)).alias("sum_rate"),
    )


@dataclass(frozen=True)
class RunStore:
    """Segments of a log, a folder for each increment; an increment that is added again replaces its own."""

    path: str
    gap_seconds: float = RUN_GAP_SECONDS
    keys: tuple[str, ...] = ("stream_id",)

    def add(self, batches: DataFrame, increment: str, ts: str = "timestamp") -> None:
        """Reduce an increment of the log, e.g. a day, to its segments; batches must not be in two increments."""
        run_segments(batches, ts, self.gap_seconds, self.keys).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/increment={increment}")

    def runs(self, spark: SparkSession) -> DataFrame:
        """All runs so far, numbered per key in time order."""
        return merge_segments(spark.read.parquet(self.path).drop("increment"), self.gap_seconds, self.keys)

    def summary(self, spark: SparkSession) -> DataFrame:
        """PRF1: one row per key about its latest run, as ``run_summary`` gives it from the whole log."""
        latest = F.row_number().over(W.partitionBy(*self.keys).orderBy(F.desc("run_id"))) == 1
        run = self.runs(spark).withColumn("__latest", latest).where("__latest")
        alone = F.col("batches") == 1

        def seconds(column: str):
            return F.when(alone, X.seconds_from_ms(F.col("first.ms"))).otherwise(X.seconds_from_ms(F.col(column)))

        mean = X.guarded_ratio(F.col("sum_ms"), F.col("n_ms")) / F.lit(1000.0)
        return run.select(
            *self.keys, "batches", *_SUMS,
            F.coalesce(X.guarded_ratio(F.col("received"), F.col("batches")), F.lit(0.0)).alias("mean_received"),
            X.guarded_ratio(F.col("inserted"), F.col("received")).alias("inserted_share"),
            X.guarded_ratio(F.col("rejected"), F.col("received")).alias("rejected_share"),
            F.when(alone, X.seconds_from_ms(F.col("first.ms"))).otherwise(mean).alias("mean_latency_s"),
            seconds("min_ms").alias("min_latency_s"),
            seconds("max_ms").alias("max_latency_s"),
            F.coalesce(X.guarded_ratio(F.col("sum_rate"), F.col("n_rate")), F.lit(0.0)).alias("mean_rows_per_second"),
        )
