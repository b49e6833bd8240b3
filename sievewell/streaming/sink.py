"""The validity-routed micro-batch sink: SNK3, SNK4, SNK6, SNK7, FLT9, FLT10, AGG7, STR9, UDF2.

Rows stay in DataFrames up to the writer: no per-partition Python function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Protocol

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell import schemas
from sievewell.operators.validation import first_failure, sink_rules, split_valid
from sievewell.plans.scratch import cached
from sievewell.streaming.commits import CommitLog, committed_only, read_counts  # noqa: F401
from sievewell.streaming.keyed_table import BatchFacts, KeyedParquetTable, batch_folder, check_stream_id, files_for

REASON = "validation_reason"


class KeyedTable(Protocol):
    """What the sink needs of its target."""

    key: str

    def prepare(self, spark: SparkSession) -> None: ...

    def plan_insert(self, rows: DataFrame, facts: BatchFacts) -> Callable[[], int]: ...


class ContractViolation(ValueError):
    """Rows that passed validation do not fit the sink table."""


@dataclass(frozen=True)
class BatchOutcome:
    """Counts of one micro-batch."""

    stream_id: str
    batch_id: int
    received: int
    inserted: int
    rejected: int


@dataclass(frozen=True)
class RoutedSink:
    """Valid rows to a keyed table, other rows to a reject table, counts to a log.

    ``table`` receives valid rows, ``rejects_path`` is a parquet folder
    partitioned by (stream_id, batch_id), and ``counts_path`` holds the commit
    log: a batch's record there, written when all else is, has its counts and
    makes its inserted and rejected rows visible in the same moment.  A batch
    that failed on the way is not seen, and is written over when it comes
    again; a committed one that comes again is left as it is.  A valid row
    that the table's contract does not admit fails the batch before anything
    is written.

    With ``outcomes_path``, the counts are kept for each value of the column
    ``partition`` besides (a source file, a tenant): rows received and rejected
    as the batch has them, rows inserted as its files in the table have them.
    The table must hold that column.
    """

    table: KeyedTable
    rejects_path: str
    counts_path: str
    event_types: tuple[str, ...] = schemas.EVENT_TYPES
    check_contract: bool = True
    rows_per_file: int = 250_000
    log: CommitLog = field(default=None)
    outcomes_path: str | None = None
    partition: str | None = None

    def __post_init__(self) -> None:
        if self.outcomes_path is not None and not (isinstance(self.table, KeyedParquetTable) and self.partition in self.table.schema.names):
            raise ValueError(f"outcomes by {self.partition!r} need a parquet table that holds that column")
        if self.log is None:
            object.__setattr__(self, "log", CommitLog(self.counts_path))
        if isinstance(self.table, KeyedParquetTable) and self.table.commits is None:
            object.__setattr__(self, "table", replace(self.table, commits=self.counts_path, _index=[], _elsewhere={}))

    def prepare(self, spark: SparkSession) -> None:
        self.table.prepare(spark)

    def write_batch(self, batch: DataFrame, batch_id: int, stream_id: str) -> BatchOutcome | None:
        """SNK3: route one batch; None for an empty one.

        The source is read once: the batch is cached while one aggregate, the
        insert and the reject write use it.
        """
        spark = batch.sparkSession
        done = self.log.find(spark, check_stream_id(stream_id), batch_id)
        if done is not None:
            return BatchOutcome(**{f: done[f] for f in BatchOutcome.__dataclass_fields__})
        with cached(batch) as rows:
            facts, outcome = self._measure(rows, batch_id, stream_id)
            if outcome.received == 0:
                return None
            # Stamped after the cache, so that the plan up to there has no
            # literal that changes from batch to batch (and needs no new code).
            stamped = rows if "processing_time" in rows.columns else rows.withColumn("processing_time", F.current_timestamp())
            valid, invalid = split_valid(stamped)
            insert = self.table.plan_insert(valid, facts) if facts.valid else None
            files = files_for(outcome.rejected, self.rows_per_file)
            rejecting = self._start_rejects(invalid.coalesce(files), facts) if outcome.rejected else None
            try:
                inserted = insert() if insert else 0
            finally:
                if rejecting is not None:
                    rejecting()
            if self.outcomes_path is not None:
                self._write_outcomes(rows, facts, inserted)
        final = BatchOutcome(stream_id, batch_id, outcome.received, inserted, outcome.rejected)
        self._commit(spark, final, facts)
        return final

    @cached_property
    def _measures(self) -> list[Column]:
        """What one pass finds out about a batch; built once, used for every batch."""
        valid = F.col("is_valid")
        key = F.when(valid, F.col(self.table.key))
        misfit = first_failure(sink_rules(self.event_types)) if self.check_contract else F.lit(None).cast("string")
        return [
            F.count(F.lit(1)).alias("received"),
            F.count_if(valid).alias("valid"),
            F.min(key).alias("key_from"),
            F.max(key).alias("key_to"),
            F.min(F.when(valid, misfit)).alias("misfit"),
        ]

    def _measure(self, rows: DataFrame, batch_id: int, stream_id: str) -> tuple[BatchFacts, BatchOutcome]:
        found = rows.agg(*self._measures).first()
        if found.misfit is not None:
            raise ContractViolation(f"batch {batch_id} of {stream_id}: valid rows break the sink contract: {found.misfit}")
        facts = BatchFacts(stream_id, batch_id, found.valid, found.key_from, found.key_to)
        return facts, BatchOutcome(stream_id, batch_id, found.received, 0, found.received - found.valid)

    def _start_rejects(self, rows: DataFrame, facts: BatchFacts) -> Callable[[], None]:
        """SNK6: write the reject partition beside the insert; the result waits for it."""
        folder = batch_folder(self.rejects_path, facts.stream_id, facts.batch_id)
        failure: list[BaseException] = []

        def write() -> None:
            try:
                rows.write.mode("overwrite").parquet(folder)
            except BaseException as e:
                failure.append(e)

        # Inherits the query's job group, so stopping the query stops this too.
        thread = InheritableThread(target=write)
        thread.start()

        def wait() -> None:
            thread.join()
            if failure:
                raise failure[0]

        return wait

    def _write_outcomes(self, rows: DataFrame, facts: BatchFacts, inserted: int) -> None:
        """SNK4: received, inserted and rejected rows for each value of the partition column, seen once the batch is committed."""
        by = F.col(self.partition).cast(self.table.schema[self.partition].dataType).alias("partition")
        counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("received"), F.count_if(~F.col("is_valid")).alias("rejected"))
        if inserted:
            folder = batch_folder(self.table.path, facts.stream_id, facts.batch_id)
            written = rows.sparkSession.read.schema(self.table.schema).parquet(folder)
            written = written.groupBy(F.col(self.partition).alias("__partition")).agg(F.count(F.lit(1)).alias("inserted"))
            counts = counts.join(written, F.col("partition").eqNullSafe(F.col("__partition")), "left").drop("__partition")
        else:
            counts = counts.withColumn("inserted", F.lit(None).cast("bigint"))
        counts = counts.select("partition", "received", F.coalesce("inserted", F.lit(0).cast("bigint")).alias("inserted"), "rejected")
        counts.write.mode("overwrite").parquet(batch_folder(self.outcomes_path, facts.stream_id, facts.batch_id))

    def read_outcomes(self, spark: SparkSession) -> DataFrame:
        """(partition, received, inserted, rejected, stream_id, batch_id) of committed batches."""
        shape = T.StructType([T.StructField("partition", self.table.schema[self.partition].dataType), *[T.StructField(c, T.LongType()) for c in ("received", "inserted", "rejected")]])
        rows = spark.read.schema(schemas.with_batch_keys(shape)).parquet(self.outcomes_path)
        done = self.log.read(spark).select(*schemas.BATCH_KEYS)
        return rows.join(done, list(schemas.BATCH_KEYS), "left_semi").select(rows.columns)

    def _commit(self, spark: SparkSession, outcome: BatchOutcome, facts: BatchFacts) -> None:
        """SNK7: the batch's counts, and from here on its rows."""
        bounds = [x if isinstance(x, str) else None for x in (facts.key_from, facts.key_to)]
        record = {**vars(outcome), "key_from": bounds[0], "key_to": bounds[1]}
        self.log.add(spark, record)
        after = getattr(self.table, "after_commit", None)
        if after is not None:
            after(spark, record)


def partition_counts(rows: DataFrame, valid: str = "is_valid") -> DataFrame:
    """SNK4: received, valid and rejected rows of each partition of a batch."""
    return rows.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col(valid)).alias("valid"),
        F.count_if(~F.col(valid)).alias("rejected"),
    )


def read_rejects(spark: SparkSession, path: str, schema, commits: str | None = None) -> DataFrame:
    """The reject table; ``schema`` is that of the validated rows. With the sink's ``counts_path``, committed batches only."""
    rows = spark.read.schema(schemas.with_batch_keys(schema)).parquet(path)
    return rows if commits is None else committed_only(rows, commits, "rejected")
