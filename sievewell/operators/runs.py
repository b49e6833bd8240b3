"""Runs in time-stamped logs and run-level performance summaries.

WIN13, JON5, JON6, AGG6, AGG8-AGG10, PRJ29, PRJ31, PRF1-PRF3, CHT6, CHT7, FLT12.

A log may carry several streams; ``keys`` names the columns that tell them
apart (empty: one stream).  Batches are identified by ``keys`` + batch id,
since batch ids start again at 0 with every new checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievewell.functions import expressions as X
from sievewell.operators.charts import long_series
from sievewell.plans.skew import salted_lookup

# Fixed value: a longer pause between two batches starts a new run.
RUN_GAP_SECONDS = 30

_T, _BIN, _FROM, _TO = "__t", "__bin", "__from", "__to"


def _on_micros(df: DataFrame, ts: str, gap_seconds: float) -> tuple[DataFrame, int]:
    kind = dict(df.dtypes)[ts]
    gap = int(round(gap_seconds * 1_000_000))
    if gap < 1:
        raise ValueError(f"a gap of {gap_seconds} seconds is below one microsecond")
    micros = X.epoch_micros(F.col(ts), kind)
    return df.withColumns({_T: micros, _BIN: F.floor(micros / F.lit(gap)).cast("bigint")}), gap


def _bin_edges(stamped: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stamped.filter(F.col(_T).isNotNull()).groupBy(*keys, _BIN).agg(
        F.min(_T).alias(_FROM), F.max(_T).alias(_TO), F.count(F.lit(1)).alias("__n")
    )


def _starts_run(keys: Sequence[str], gap: int) -> Column:
    before = F.lag(_TO).over(W.partitionBy(*keys).orderBy(_BIN))
    return F.coalesce(F.col(_FROM) - before > F.lit(gap), F.lit(True))


def run_bins(df: DataFrame, ts: str, *, gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ()) -> DataFrame:
    """Time bins one gap wide with the run each belongs to.

    Two rows in one bin are less than a gap apart, so a run can only start at
    a bin's first row: the rows are first reduced (map-side) to one row per
    bin, and only bins are put in sequence.  Their number depends on the time
    covered, not on the rows.
    """
    stamped, gap = _on_micros(df, ts, gap_seconds)
    flagged = _bin_edges(stamped, keys).withColumn("__new", _starts_run(keys, gap).cast("int"))
    so_far = W.partitionBy(*keys).orderBy(_BIN).rowsBetween(W.unboundedPreceding, W.currentRow)
    return flagged.withColumn("run_id", F.sum("__new").over(so_far)).drop("__new")


def assign_runs(df: DataFrame, ts: str, *, gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ()) -> DataFrame:
    """WIN13: every row with ``run_id`` (1, 2, ... per key in time order).

    A pause strictly longer than ``gap_seconds`` starts a new run; rows without
    a time get no run.
    """
    stamped, _ = _on_micros(df, ts, gap_seconds)
    bins = run_bins(df, ts, gap_seconds=gap_seconds, keys=keys).select(*keys, _BIN, "run_id")
    return salted_lookup(stamped, bins, [*keys, _BIN], [_T], how="left").drop(_T, _BIN)


def run_spans(df: DataFrame, ts: str, *, gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ()) -> DataFrame:
    """First and last time of each run, in epoch microseconds, with its row count."""
    return run_bins(df, ts, gap_seconds=gap_seconds, keys=keys).groupBy(*keys, "run_id").agg(
        F.min(_FROM).alias("first_us"), F.max(_TO).alias("last_us"), F.sum("__n").alias("n")
    )


def latest_run(df: DataFrame, ts: str, *, gap_seconds: float = RUN_GAP_SECONDS, keys: Sequence[str] = ()) -> DataFrame:
    """WIN13: rows of the last run of each key.

    The last run starts at the last bin that starts any run; rows from there
    on belong to it.
    """
    stamped, gap = _on_micros(df, ts, gap_seconds)
    starts = (
        _bin_edges(stamped, keys)
        .withColumn("__new", _starts_run(keys, gap))
        .filter("__new")
        .groupBy(*keys)
        .agg(F.max(_FROM).alias("__start"))
    )
    if keys:
        recent = salted_lookup(stamped, starts, keys, [_T]).filter(F.col(_T) >= F.col("__start")).drop("__start")
    else:
        recent = stamped.filter(F.col(_T) >= starts.select("__start").scalar())
    return recent.drop(_T, _BIN)


def nonempty_progress(progress: DataFrame) -> DataFrame:
    """FLT12: progress rows that read something."""
    return progress.filter(F.col("num_input_rows") > 0)


def timed_progress(progress: DataFrame, ts: str = "timestamp", pattern: str = X.PROGRESS_TIME_PATTERN) -> DataFrame:
    """PRJ31: the log's time text as a timestamp."""
    return progress.withColumn(ts, X.to_instant(F.col(ts), pattern))


def of_batches(rows: DataFrame, batches: DataFrame, keys: Sequence[str] = ("stream_id",), batch: str = "batch_id") -> DataFrame:
    """JON6: rows whose batch is among ``batches``.

    One bounded row per micro-batch on the right; broadcasting it is left to
    Spark, which knows its size.
    """
    ids = [*keys, batch]
    return rows.join(batches.select(*ids).distinct(), ids, "left_semi")


def batch_detail(
    counts: DataFrame, progress: DataFrame, keys: Sequence[str] = ("stream_id",), batch: str = "batch_id"
) -> DataFrame:
    """JON5/PRF2: per batch received, inserted, rejected and seconds taken."""
    ids = [*keys, batch]
    return counts.join(progress.select(*ids, "batch_duration_ms"), ids).select(
        *ids, "received", "inserted", "rejected", X.seconds_from_ms(F.col("batch_duration_ms")).alias("seconds")
    )


def with_rows_read(
    counts: DataFrame, progress: DataFrame, keys: Sequence[str] = ("stream_id",), batch: str = "batch_id"
) -> DataFrame:
    """Counts with ``received`` as the rows the query read, and ``repeats`` among them.

    For streams that keep repeated keys from the sink by state; a batch absent
    from the progress log keeps its own count.
    """
    ids = [*keys, batch]
    read = F.coalesce("num_input_rows", "received")
    joined = counts.join(progress.select(*ids, "num_input_rows"), ids, "left")
    return joined.select(
        *ids,
        read.alias("received"),
        "inserted",
        "rejected",
        (read - F.col("inserted") - F.col("rejected")).alias("repeats"),
    )


def count_summary(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """AGG8: totals, batches and mean received per batch, with shares of the total."""
    totals = counts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("received", "inserted", "rejected")],
    )
    return totals.withColumns(
        {
            "mean_received": F.coalesce(X.guarded_ratio(F.col("received"), F.col("batches")), F.lit(0.0)),
            "inserted_share": X.guarded_ratio(F.col("inserted"), F.col("received")),
            "rejected_share": X.guarded_ratio(F.col("rejected"), F.col("received")),
        }
    )


def warm_summary(
    progress: DataFrame, ts: str = "timestamp", keys: Sequence[str] = (), batch: str = "batch_id"
) -> DataFrame:
    """AGG9/AGG10: latency and throughput without each key's first batch.

    Latency falls back to the first batch when it is the only one; throughput
    is then 0.
    """
    first = progress.groupBy(*keys).agg(
        F.min(F.struct(F.col(ts), F.col(batch))).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    if keys:
        placed = salted_lookup(progress, first, keys, [ts, batch])
    else:
        placed = progress.withColumn("__f", first.select(F.struct("__first", "__n")).scalar()).select(
            *progress.columns, "__f.__first", "__f.__n"
        )
    warm = F.struct(F.col(ts), F.col(batch)) != F.col("__first")
    seconds = F.when(warm | (F.col("__n") == 1), X.seconds_from_ms(F.col("batch_duration_ms")))
    return placed.groupBy(*keys).agg(
        F.avg(seconds).alias("mean_latency_s"),
        F.min(seconds).alias("min_latency_s"),
        F.max(seconds).alias("max_latency_s"),
        F.coalesce(F.avg(F.when(warm, F.col("processed_rows_per_second"))), F.lit(0.0)).alias("mean_rows_per_second"),
    )


def run_summary(
    counts: DataFrame,
    progress: DataFrame,
    *,
    ts: str = "timestamp",
    gap_seconds: float = RUN_GAP_SECONDS,
    keys: Sequence[str] = ("stream_id",),
    batch: str = "batch_id",
) -> DataFrame:
    """PRF1: one row per key (one row in all without keys) about its latest run."""
    recent = latest_run(progress, ts, gap_seconds=gap_seconds, keys=keys)
    totals = count_summary(of_batches(counts, recent, keys, batch), keys)
    warm = warm_summary(recent, ts, keys, batch)
    if keys:
        return totals.join(warm, list(keys))
    # Both sides are the single row of a global aggregate.
    timing = ["mean_latency_s", "min_latency_s", "max_latency_s", "mean_rows_per_second"]
    return totals.withColumn("__w", warm.select(F.struct(*timing)).scalar()).select("*", "__w.*").drop("__w")


def run_reasons(
    rejects: DataFrame,
    recent: DataFrame,
    keys: Sequence[str] = ("stream_id",),
    batch: str = "batch_id",
    reason: str = "validation_reason",
) -> DataFrame:
    """PRF3: reject reasons of the given batches, by reason.

    Rejects are counted per batch and reason first, so the join and what
    follows see a few rows per batch however many were rejected.
    """
    ids = [*keys, batch]
    per_batch = rejects.groupBy(*ids, reason).agg(F.count(reason).alias("__n"))
    kept = of_batches(per_batch, recent, keys, batch)
    return kept.groupBy(reason).agg(F.sum("__n").alias("n")).filter(F.col("n") > 0).orderBy(reason)


def outcome_series(counts: DataFrame, ids: Sequence[str] = ("stream_id", "batch_id")) -> DataFrame:
    """CHT6: per batch one row each for inserted and rejected."""
    return long_series(counts, ids, ["inserted", "rejected"])


def latency_series(progress: DataFrame, ids: Sequence[str] = ("stream_id", "batch_id")) -> DataFrame:
    """CHT7: per batch the seconds it took."""
    return progress.select(*ids, X.seconds_from_ms(F.col("batch_duration_ms")).alias("seconds"))
