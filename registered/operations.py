"""Runs and performance summaries over batch logs derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.book import register
from registered.frames import BATCH_LOGS_SQL, TYPED_EVENTS_SQL, batch_logs, raw_events, table
from sievewell.functions import expressions as X
from sievewell.operators import runs as R
from sievewell.operators import validation as V
from sievewell.operators.run_segments import RunStore
from sievewell.plans.performance import run_report
from sievewell.plans.scratch import materialized, scratch_path
from sievewell.schemas import COUNTS_SCHEMA, PROGRESS_SCHEMA
from sievewell.sources.readers import read_log_csv, read_reject_csv
from sievewell.streaming.sink import partition_counts

EVENT_GAP, LOG_GAP = 1800, 6000

_EVENT_RUNS_SQL = """
gaps AS (
  SELECT event_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (ORDER BY ts, event_id) AS before FROM events
),
runs AS (
  SELECT event_id, us, sum(CASE WHEN before IS NULL OR us - before > 1800000000 THEN 1 ELSE 0 END)
         OVER (ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run_id FROM gaps
)"""


@register("event_runs", "WIN13", f"WITH {_EVENT_RUNS_SQL} SELECT event_id, run_id FROM runs")
def event_runs(spark, sf_dir):
    return R.assign_runs(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", gap_seconds=EVENT_GAP).select(
        "event_id", "run_id"
    )


@register(
    "event_run_spans",
    "WIN13",
    f"WITH {_EVENT_RUNS_SQL} SELECT run_id, min(us) AS first_us, max(us) AS last_us, count(*) AS n FROM runs GROUP BY ALL",
)
def event_run_spans(spark, sf_dir):
    return R.run_spans(table(spark, sf_dir, "events"), "ts", gap_seconds=EVENT_GAP)


@register(
    "latest_event_run",
    "WIN13",
    f"WITH {_EVENT_RUNS_SQL} SELECT event_id FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)",
)
def latest_event_run(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return R.latest_run(events, "ts", gap_seconds=EVENT_GAP).select("event_id")


_RECENT_SQL = f"""
{BATCH_LOGS_SQL},
steps AS (
  SELECT *, lag(timestamp) OVER (PARTITION BY stream_id ORDER BY timestamp, batch_id) AS before FROM batch_logs
),
starts AS (
  SELECT stream_id, max(timestamp) AS started FROM steps
  WHERE before IS NULL OR epoch_us(timestamp) - epoch_us(before) > 6000000000 GROUP BY ALL
),
recent AS (SELECT b.* FROM batch_logs b JOIN starts USING (stream_id) WHERE timestamp >= started)"""

_DETAIL = "stream_id, batch_id, received, inserted, rejected, batch_duration_ms::DOUBLE / 1e3 AS seconds"


def _logs(spark, sf_dir):
    """(progress, counts, rejects) in the form the report takes.

    Logs are tables at rest, so the derived ones are written first: the events
    are aggregated once, and the report works on a row per batch.
    """
    logs = materialized(batch_logs(spark, sf_dir), "batch-logs")
    progress = logs.select(
        "stream_id", "batch_id", "timestamp", "num_input_rows", "processed_rows_per_second", "batch_duration_ms"
    )
    counts = logs.select("stream_id", "batch_id", "received", "inserted", "rejected")
    e = table(spark, sf_dir, "events")
    rejects = e.select(
        F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("stream_id"),
        F.floor(X.epoch_micros(F.col("ts"), dict(e.dtypes)["ts"]) / F.lit(3_600_000_000)).cast("bigint").alias("batch_id"),
        F.concat(F.lit("reason_"), F.col("event_type")).alias("validation_reason"),
    )
    return progress, counts, rejects


def _report(spark, sf_dir, part: str):
    return run_report(*_logs(spark, sf_dir), gap_seconds=LOG_GAP)[part]


_RUN_SUMMARY_SQL = f"""
WITH {_RECENT_SQL},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY timestamp, batch_id) AS place, count(*) OVER (PARTITION BY stream_id) AS n
  FROM recent
)
SELECT stream_id, count(*) AS batches, sum(received)::BIGINT AS received, sum(inserted)::BIGINT AS inserted,
       sum(rejected)::BIGINT AS rejected, sum(received)::DOUBLE / count(*) AS mean_received,
       sum(inserted)::DOUBLE / sum(received)::DOUBLE AS inserted_share, sum(rejected)::DOUBLE / sum(received)::DOUBLE AS rejected_share,
       round(avg(batch_duration_ms::DOUBLE / 1e3) FILTER (place > 1 OR n = 1), 3) AS mean_latency_s,
       min(batch_duration_ms::DOUBLE / 1e3) FILTER (place > 1 OR n = 1) AS min_latency_s,
       max(batch_duration_ms::DOUBLE / 1e3) FILTER (place > 1 OR n = 1) AS max_latency_s,
       round(coalesce(avg(processed_rows_per_second) FILTER (place > 1), 0), 6) AS mean_rows_per_second
FROM placed GROUP BY stream_id"""


def _rounded(summary):
    return summary.withColumns({"mean_latency_s": F.round("mean_latency_s", 3), "mean_rows_per_second": F.round("mean_rows_per_second", 6)})


@register("run_summary", "PRF1 WIN13 JON6 AGG8 AGG9 AGG10 PRJ29 FLT12", _RUN_SUMMARY_SQL)
def run_summary(spark, sf_dir):
    return _rounded(_report(spark, sf_dir, "summary"))


@register("run_summary_by_increments", "PRF1 WIN13 AGG8 AGG9 AGG10", _RUN_SUMMARY_SQL)
def run_summary_by_increments(spark, sf_dir):
    """The log comes in five increments that cut runs in two and interleave; only their segments are read for the summary."""
    logs = materialized(batch_logs(spark, sf_dir), "batch-logs")
    store = RunStore(scratch_path(spark, "run-segments"), gap_seconds=LOG_GAP)
    for i in (3, 0, 4, 1, 2):
        store.add(logs.where(F.pmod(F.floor(F.col("batch_id") / 7), F.lit(5)) == i), f"p{i}")
    return _rounded(store.summary(spark))


@register("batch_detail", "PRF2 JON5 JON6 PRJ29", f"WITH {_RECENT_SQL} SELECT {_DETAIL} FROM recent")
def batch_detail(spark, sf_dir):
    return _report(spark, sf_dir, "detail")


@register(
    "run_reject_reasons",
    "PRF3 JON6 AGG6",
    f"""
WITH {_RECENT_SQL}
SELECT 'reason_' || event_type AS validation_reason, count(*) AS n
FROM events JOIN recent r ON r.stream_id = 's' || (user_id % 3) AND r.batch_id = epoch_us(ts) // 3600000000
GROUP BY ALL""",
)
def run_reject_reasons(spark, sf_dir):
    return _report(spark, sf_dir, "reasons")


@register(
    "chart_outcomes",
    "CHT6 JON6",
    f"""
WITH {_RECENT_SQL}
SELECT stream_id, batch_id, 'inserted' AS metric, inserted AS value FROM recent
UNION ALL SELECT stream_id, batch_id, 'rejected', rejected FROM recent""",
)
def chart_outcomes(spark, sf_dir):
    return _report(spark, sf_dir, "outcomes")


@register(
    "chart_latency",
    "CHT7 PRJ29",
    f"WITH {_RECENT_SQL} SELECT stream_id, batch_id, batch_duration_ms::DOUBLE / 1e3 AS seconds FROM recent",
)
def chart_latency(spark, sf_dir):
    return _report(spark, sf_dir, "latency")


@register(
    "log_csv_scan",
    "SRC5 PRJ31 FLT12 JON5",
    f"""
WITH {BATCH_LOGS_SQL},
per_hour AS (
  SELECT batch_id, min(timestamp) AS started, sum(received)::BIGINT AS received, sum(inserted)::BIGINT AS inserted,
         sum(rejected)::BIGINT AS rejected, sum(batch_duration_ms)::BIGINT AS took
  FROM batch_logs GROUP BY ALL
)
SELECT batch_id, epoch_us(date_trunc('milliseconds', started)) AS started_us, received, inserted, rejected, took::DOUBLE / 1e3 AS seconds
FROM per_hour""",
)
def log_csv_scan(spark, sf_dir):
    """Both logs written as header CSV and read back typed, joined on the batch."""
    hours = batch_logs(spark, sf_dir).groupBy("batch_id").agg(
        F.min("timestamp").alias("started"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("received", "inserted", "rejected", "batch_duration_ms")],
    )
    progress_path, counts_path = scratch_path(spark, "progress-log"), scratch_path(spark, "counts-log")
    hours.select(
        F.date_format("started", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        "batch_id",
        F.col("received").alias("num_input_rows"),
        F.lit(1.0).alias("processed_rows_per_second"),
        "batch_duration_ms",
    ).write.option("header", True).csv(progress_path)
    hours.select("received", "inserted", "rejected", "batch_id").write.option("header", True).csv(counts_path)
    needed = ["batch_id", "timestamp", "batch_duration_ms", "processed_rows_per_second"]
    progress = R.nonempty_progress(R.timed_progress(read_log_csv(spark, progress_path, PROGRESS_SCHEMA, needed)))
    counts = read_log_csv(spark, counts_path, COUNTS_SCHEMA)
    started = progress.select("batch_id", F.unix_micros("timestamp").alias("started_us"))
    return R.batch_detail(counts, progress, keys=[]).join(started, "batch_id")


@register(
    "reject_file_scan",
    "SRC6 AGG6",
    """
SELECT (event_id % 7)::BIGINT AS batch_id, count(*) AS n, sum(event_id)::BIGINT AS event_sum
FROM events WHERE event_type = 'error' GROUP BY ALL""",
)
def reject_file_scan(spark, sf_dir):
    """Rejected rows in folders named after their batch; the batch id comes from the path."""
    rejected = (
        table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select("event_id", (F.col("event_id") % 7).alias("rejected_batch"))
    )
    place = scratch_path(spark, "rejects")
    rejected.write.partitionBy("rejected_batch").option("header", True).csv(place)
    rows = read_reject_csv(spark, f"{place}/*/*.csv", "event_id bigint")
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("event_sum"))


@register(
    "partition_outcomes",
    "SNK4 AGG7",
    f"""
WITH {TYPED_EVENTS_SQL}
SELECT count(*) AS received, count(*) FILTER (validation_reason IS NULL) AS valid,
       count(*) FILTER (validation_reason IS NOT NULL) AS rejected FROM flagged""",
)
def partition_outcomes(spark, sf_dir):
    """Counts per partition of a cleaned batch, added up: how rows fall into partitions is Spark's choice."""
    parts = partition_counts(V.clean_events(raw_events(spark, sf_dir)))
    return parts.agg(*[F.sum(c).alias(c) for c in ("received", "valid", "rejected")])
