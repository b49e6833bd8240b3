"""The streaming query from staged event files to the routed sink, read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from registered.book import register
from registered.events import staged_event_csv
from registered.frames import TYPED_EVENTS_SQL
from sievewell.operators import summaries as S
from sievewell.operators import validation as V
from sievewell.plans.scratch import materialized, scratch_path
from sievewell.schemas import RAW_EVENT_SCHEMA
from sievewell.streaming.commits import CommitLog
from sievewell.streaming.keyed_table import KeyedParquetTable
from sievewell.streaming.progress import ProgressRecorder, RollingLog
from sievewell.streaming.runner import run_stream
from sievewell.streaming.sink import RoutedSink, read_counts, read_rejects

FILES = 4
STATE_PARTITIONS = 4

_STRICT = f"""
{TYPED_EVENTS_SQL},
routed AS (
  SELECT * REPLACE (CASE WHEN n % 59 = 13 THEN 'corrupt_csv_row' ELSE validation_reason END AS validation_reason) FROM strict
)"""


def new_sink(spark, distinct_stream: bool = False) -> RoutedSink:
    base = scratch_path(spark, "sink")
    table = KeyedParquetTable(f"{base}/events", distinct_stream=distinct_stream)
    return RoutedSink(table, f"{base}/rejects", f"{base}/counts")


def drained(spark, sf_dir, times: int = 1, distinct_stream: bool = False, sink: RoutedSink | None = None):
    """The sink after draining the staged files ``times`` times, each from a new checkpoint."""
    source, sink = staged_event_csv(spark, sf_dir, files=FILES), sink or new_sink(spark, distinct_stream)
    for _ in range(times):
        query, _writer = run_stream(
            spark, source, sink, scratch_path(spark, "checkpoint"), once=True, rules=V.contract_rules(),
            state_partitions=STATE_PARTITIONS if distinct_stream else None,
        )
    return sink, query


def stored(spark, sink):
    return sink.table.read(spark).select(
        "event_id", F.unix_micros("event_time").alias("event_us"), "user_id", "session_id", "event_type", "product_id",
        "product_name", "category", F.col("price").cast("double").alias("price"), "quantity",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


_STORED_SQL = f"""
WITH {_STRICT}
SELECT event_id, event_us, user_id, session_id, event_type, product_id, product_name, category, price, quantity,
       round(price * quantity, 2) AS total_amount
FROM routed WHERE validation_reason IS NULL"""


@register("stream_valid", "SRC3 SRC4 SRC7 SNK3 SNK5 SNK9 STR1 STR2 STR3 STR6 DED2 JON7 FLT9 PRJ22", _STORED_SQL)
def stream_valid(spark, sf_dir):
    sink, _ = drained(spark, sf_dir)
    return stored(spark, sink)


@register("stream_replay", "STR7 SNK5 DED2 JON7", _STORED_SQL)
def stream_replay(spark, sf_dir):
    """The same files delivered again under a new checkpoint add nothing."""
    sink, _ = drained(spark, sf_dir, times=2)
    return stored(spark, sink)


@register("stream_first_arrivals", "STR7 SNK5 DED2 JON7", _STORED_SQL)
def stream_first_arrivals(spark, sf_dir):
    """Repeats kept out by streaming state; the second delivery still meets the first one's rows."""
    sink, _ = drained(spark, sf_dir, times=2, distinct_stream=True)
    return stored(spark, sink)


@register("stream_indexed", "SNK5 DED2 JON7 STR7", _STORED_SQL)
def stream_indexed(spark, sf_dir):
    """Delivered twice; stored keys are found in merged runs of the key index, through the filters of their buckets."""
    base = scratch_path(spark, "sink")
    table = KeyedParquetTable(f"{base}/events", compact_at=3, filter_from=0)
    sink, _ = drained(spark, sf_dir, times=2, sink=RoutedSink(table, f"{base}/rejects", f"{base}/counts"))
    return stored(spark, sink)


class FailsOnce(CommitLog):
    """Breaks off before the record of one batch, when its rows and rejects are written."""

    failed = False

    def add(self, spark, record):
        if record["batch_id"] == 2 and not self.failed:
            object.__setattr__(self, "failed", True)
            raise OSError("no commit for batch 2")
        super().add(spark, record)


@register(
    "stream_recovery",
    "STR9 SNK3 SNK6 SNK7 STR3",
    f"""
WITH {_STRICT}, n AS (
  SELECT count(*) AS received, count(*) FILTER (validation_reason IS NULL) AS inserted,
         count(*) FILTER (validation_reason IS NOT NULL) AS rejected FROM routed
), seen(moment, batches) AS (VALUES ('failed', 2::BIGINT), ('restarted', {FILES}::BIGINT))
SELECT moment, batches, 0::BIGINT AS unmatched, CASE WHEN moment = 'restarted' THEN received END AS received,
       CASE WHEN moment = 'restarted' THEN inserted END AS inserted, CASE WHEN moment = 'restarted' THEN rejected END AS rejected
FROM seen, n""",
)
def stream_recovery(spark, sf_dir):
    """A batch that fails between its writes and its commit, and the restart: what readers see of table, rejects and counts each time.

    ``unmatched`` counts batches whose visible rows are not those of their counts.
    """
    base, shape = scratch_path(spark, "sink"), V.clean_events(spark.createDataFrame([], RAW_EVENT_SCHEMA)).schema
    log = FailsOnce(f"{base}/counts")
    sink = RoutedSink(KeyedParquetTable(f"{base}/events"), f"{base}/rejects", f"{base}/counts", log=log)
    source, checkpoint = staged_event_csv(spark, sf_dir, files=FILES), scratch_path(spark, "checkpoint")

    def seen(moment: str, whole: bool):
        keys = ["stream_id", "batch_id"]
        per_batch = [
            rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
            for name, rows in (("in_table", sink.table.read(spark)), ("in_rejects", read_rejects(spark, sink.rejects_path, shape, sink.counts_path)))
        ]
        both = read_counts(spark, sink.counts_path).join(per_batch[0], keys, "full").join(per_batch[1], keys, "full").na.fill(0, ["in_table", "in_rejects"])
        fits = F.col("inserted").eqNullSafe(F.col("in_table")) & F.col("rejected").eqNullSafe(F.col("in_rejects"))
        return both.agg(
            F.lit(moment).alias("moment"), F.count("received").alias("batches"), F.count_if(~fits).alias("unmatched"),
            *[(F.sum(c) if whole else F.lit(None).cast("bigint")).alias(c) for c in ("received", "inserted", "rejected")],
        )

    run = dict(once=True, rules=V.contract_rules(), stream_id="recovered")
    try:
        run_stream(spark, source, sink, checkpoint, **run)
    except StreamingQueryException:
        # Kept, as the restart changes what there is to see.
        failed = materialized(seen("failed", whole=False), "failed")
    run_stream(spark, source, sink, checkpoint, **run)
    return failed.unionByName(seen("restarted", whole=True))


@register(
    "stream_rejected",
    "SNK6 FLT9 AGG6",
    f"WITH {_STRICT} SELECT validation_reason, count(*) AS n FROM routed WHERE validation_reason IS NOT NULL GROUP BY ALL",
)
def stream_rejected(spark, sf_dir):
    sink, _ = drained(spark, sf_dir)
    shape = V.clean_events(spark.createDataFrame([], RAW_EVENT_SCHEMA)).schema
    return S.reason_tally(read_rejects(spark, sink.rejects_path, shape, sink.counts_path))


@register(
    "stream_counts",
    "SNK7 AGG7 FLT10",
    f"""
WITH {_STRICT}
SELECT {FILES}::BIGINT AS batches, count(*) AS received, count(*) FILTER (validation_reason IS NULL) AS inserted,
       count(*) FILTER (validation_reason IS NOT NULL) AS rejected FROM routed""",
)
def stream_counts(spark, sf_dir):
    sink, _ = drained(spark, sf_dir)
    return read_counts(spark, sink.counts_path).agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.sum(c).alias(c) for c in ("received", "inserted", "rejected")],
    )


@register(
    "stream_partition_outcomes",
    "SNK4 AGG7 SNK5",
    f"""
WITH {_STRICT}, first_time AS (
  SELECT event_type AS part, count(*) AS received, count(*) FILTER (validation_reason IS NULL) AS inserted,
         count(*) FILTER (validation_reason IS NOT NULL) AS rejected FROM routed GROUP BY ALL
)
SELECT part, 2 * received AS received, inserted, 2 * rejected AS rejected FROM first_time""",
)
def stream_partition_outcomes(spark, sf_dir):
    """Outcomes by event type; all files come twice, so that half of what is valid is not inserted."""
    base = scratch_path(spark, "sink")
    sink = RoutedSink(KeyedParquetTable(f"{base}/events"), f"{base}/rejects", f"{base}/counts", outcomes_path=f"{base}/outcomes", partition="event_type")
    drained(spark, sf_dir, times=2, sink=sink)
    return sink.read_outcomes(spark).groupBy(F.col("partition").alias("part")).agg(*[F.sum(c).alias(c) for c in ("received", "inserted", "rejected")])


@register(
    "stream_progress",
    "SNK8 STR8 FLT12",
    f"SELECT {FILES}::BIGINT AS batches, count(*) AS num_input_rows FROM events",
)
def stream_progress(spark, sf_dir):
    """Progress of the finished query as its listener logged it; every source row is read exactly once."""
    log = scratch_path(spark, "progress")
    recorder = ProgressRecorder(spark, log)
    spark.streams.addListener(recorder)
    try:
        _, query = drained(spark, sf_dir)
        recorder.wait_ended()
    finally:
        spark.streams.removeListener(recorder)
    return RollingLog(spark, log).read().where(F.col("stream_id") == str(query.id)).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("num_input_rows").alias("num_input_rows")
    )


@register("stream_type_tally", "AGG11 SRC7", f"WITH {_STRICT} SELECT event_type, count(*) AS n FROM routed WHERE validation_reason IS NULL GROUP BY ALL")
def stream_type_tally(spark, sf_dir):
    sink, _ = drained(spark, sf_dir)
    return S.tally(sink.table.read(spark), "event_type")
