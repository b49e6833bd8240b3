"""Performance report of a stream from its logs: PRF1-PRF3, CHT6, CHT7."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from sievewell.operators import runs as R


def run_report(
    progress: DataFrame,
    counts: DataFrame,
    rejects: DataFrame,
    *,
    keys: Sequence[str] = ("stream_id",),
    gap_seconds: float = R.RUN_GAP_SECONDS,
) -> Mapping[str, DataFrame]:
    """Summary, per-batch detail, reject reasons and chart series of the latest run, lazily.

    ``progress`` has its time as text or timestamp; ``rejects`` needs the
    batch columns and ``validation_reason``.
    """
    timed = R.timed_progress(progress) if dict(progress.dtypes)["timestamp"] == "string" else progress
    recent = R.latest_run(R.nonempty_progress(timed), "timestamp", gap_seconds=gap_seconds, keys=keys)
    recent_counts = R.of_batches(counts, recent, keys)
    ids = [*keys, "batch_id"]
    return {
        "summary": R.run_summary(counts, R.nonempty_progress(timed), gap_seconds=gap_seconds, keys=keys),
        "detail": R.batch_detail(recent_counts, recent, keys),
        "reasons": R.run_reasons(rejects, recent, keys),
        "outcomes": R.outcome_series(recent_counts, ids),
        "latency": R.latency_series(recent, ids),
    }
