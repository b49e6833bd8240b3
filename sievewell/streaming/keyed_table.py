"""Keyed sink tables that take each key once: SNK5, SNK9, DED2, JON7, STR7."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell import schemas
from sievewell.operators.cleaning import one_per_key
from sievewell.plans.scratch import cached
from sievewell.sources.readers import read_jdbc, read_keyed_table
from sievewell.streaming.commits import committed_only
from sievewell.streaming.key_index import COMPACT_AT, FILTER_FROM, KeyIndex

_SAFE_ID = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass(frozen=True)
class BatchFacts:
    """What one pass over a micro-batch has established about its valid rows."""

    stream_id: str
    batch_id: int
    valid: int
    key_from: object = None
    key_to: object = None


def check_stream_id(stream_id: str) -> str:
    """A stream id becomes a folder name."""
    if not _SAFE_ID.fullmatch(stream_id):
        raise ValueError(f"stream id {stream_id!r} may only hold letters, digits and _ . -")
    return stream_id


def to_sink_row(df: DataFrame, schema: T.StructType, stamp: str | None = "ingested_at") -> DataFrame:
    """SNK9: the sink's columns and types, in order, stamped at write time.

    A value that does not fit its column becomes NULL; ``sink_rules`` names
    those rows beforehand.
    """
    return df.selectExpr(
        *[
            f"current_timestamp() AS `{f.name}`"
            if f.name == stamp
            else f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema.fields
        ]
    )


def batch_folder(path: str, stream_id: str, batch_id: int) -> str:
    """The partition folder of one batch."""
    return f"{path}/stream_id={check_stream_id(stream_id)}/batch_id={batch_id}"


def files_for(rows: int, rows_per_file: int) -> int:
    """Number of files for a counted number of rows."""
    return max(1, -(-rows // rows_per_file))


def unseen(rows: DataFrame, stored: DataFrame, key: str, facts: BatchFacts, broadcast_limit: int) -> DataFrame:
    """DED2/JON7: rows whose key is not stored.

    The stored table may be far larger than the batch, so it is never shuffled
    or broadcast as a whole: only its keys within the batch's key range are
    read (a range that row-group statistics can skip by), matched against the
    batch's keys, and the few hits taken out of the batch.  Keys and hits are
    broadcast while the counted size of the batch, which bounds both, is
    within ``broadcast_limit``; a larger batch is joined by shuffle.
    """
    small = facts.valid <= broadcast_limit
    wanted = rows.select(key)
    in_range = F.col(key).between(F.lit(facts.key_from), F.lit(facts.key_to))
    hits = stored.select(key).filter(in_range).join(F.broadcast(wanted) if small else wanted, key, "left_semi")
    return rows.join(F.broadcast(hits) if small else hits, key, "left_anti")


@dataclass(frozen=True)
class KeyedParquetTable:
    """A parquet table partitioned by (stream_id, batch_id), each key stored once.

    One writer at a time is assumed.  With ``commits`` (a sink's commit log)
    only committed batches are read and compared, and stored keys are found by
    a persistent index (``key_index``): the files that a batch opens are a few,
    however many batches there were.  The same events under another stream id
    (a lost checkpoint) add nothing.
    ``stored_filter`` may instead restrict which stored rows can hold a
    repeated key (say, the last week); all batches are then looked through.
    A batch is written as one file per ``rows_per_file`` counted rows, so that
    small batches do not leave many files (nor need a shuffle).

    ``distinct_stream`` says that a stream never hands over a key twice (see
    ``runner.first_arrivals``).  Only rows of other streams are then compared,
    listed once per run, and not at all when there are none.
    """

    path: str
    key: str = "event_id"
    schema: T.StructType = field(default_factory=lambda: schemas.SINK_SCHEMA)
    prefer: Sequence[str] = ("event_time",)
    broadcast_limit: int = 1_000_000
    rows_per_file: int = 250_000
    stored_filter: Column | None = None
    distinct_stream: bool = False
    commits: str | None = None
    filter_from: int = FILTER_FROM
    compact_at: int = COMPACT_AT
    _index: list[KeyIndex] = field(default_factory=list, repr=False, compare=False)
    _elsewhere: dict[str, DataFrame | None] = field(default_factory=dict, repr=False, compare=False)

    def prepare(self, spark: SparkSession) -> None:
        """Make the table readable before its first batch."""
        empty = spark.createDataFrame([], schemas.with_batch_keys(self.schema))
        empty.write.mode("append").partitionBy(*schemas.BATCH_KEYS).parquet(self.path)
        self._elsewhere.clear()
        self._index.clear()

    def read(self, spark: SparkSession) -> DataFrame:
        return read_keyed_table(spark, self.path, self.schema, self.commits)

    def plan_insert(self, rows: DataFrame, facts: BatchFacts) -> Callable[[], int]:
        """SNK5: an insert of the rows with new keys as the batch's partition.

        Calling it writes and returns how many rows that were.
        """
        spark = rows.sparkSession
        if self.distinct_stream:
            stored = self._of_other_streams(spark, facts)
        elif self.commits is None or self.stored_filter is not None:
            stored = self._of_other_batches(spark, facts)
        else:
            stored = self._indexed(spark, rows, facts)
        if stored is not None and self.stored_filter is not None:
            stored = stored.filter(self.stored_filter)
        new = rows if stored is None else unseen(rows, stored, self.key, facts, self.broadcast_limit)
        files = files_for(facts.valid, self.rows_per_file)
        if self.distinct_stream:
            new = new.coalesce(files)
        else:
            # With one partition the window needs no shuffle; with more, the
            # adaptive shuffle sizes the files.
            new = one_per_key(new.coalesce(1) if files == 1 else new, self.key, self._survivor_order())
        written = Observation()
        shaped = to_sink_row(new, self.schema).observe(written, F.count(F.lit(1)).alias("n"))
        folder = batch_folder(self.path, facts.stream_id, facts.batch_id)

        def insert() -> int:
            shaped.write.mode("overwrite").parquet(folder)
            # Counted in the writing tasks themselves.
            return written.get["n"]

        return insert

    def index(self) -> KeyIndex:
        """Kept for as long as this table object, as it holds what it has read of the index."""
        if not self._index:
            kind = self.schema[self.key].dataType
            folder_of = lambda stream, batch: batch_folder(self.path, stream, batch)
            self._index.append(KeyIndex(self.path, self.commits, self.key, kind, folder_of, self.filter_from, compact_at=self.compact_at))
        return self._index[0]

    def after_commit(self, spark: SparkSession, record: dict) -> None:
        """The sink has committed a batch."""
        if self.commits and self._index:
            self.index().note(spark, record)

    def _indexed(self, spark: SparkSession, rows: DataFrame, facts: BatchFacts) -> DataFrame | None:
        own = (check_stream_id(facts.stream_id), facts.batch_id)
        stored = self.index().stored(spark, rows.select(F.col(self.key).alias("key")), facts.key_from, facts.key_to, own)
        return None if stored is None else stored.withColumnRenamed("key", self.key)

    def _of_other_batches(self, spark: SparkSession, facts: BatchFacts) -> DataFrame:
        stream = check_stream_id(facts.stream_id)
        return self.read(spark).filter(f"NOT (stream_id = '{stream}' AND batch_id = {facts.batch_id:d})")

    def _of_other_streams(self, spark: SparkSession, facts: BatchFacts) -> DataFrame | None:
        stream = check_stream_id(facts.stream_id)
        if stream not in self._elsewhere:
            others = self.read(spark).filter(f"stream_id <> '{stream}'")
            self._elsewhere[stream] = None if others.isEmpty() else others
        return self._elsewhere[stream]

    def _survivor_order(self) -> list[str]:
        rest = [c for c in self.schema.fieldNames() if c not in (self.key, *self.prefer, "ingested_at")]
        return [*self.prefer, *rest]


@dataclass(frozen=True)
class JdbcTable:
    """A database table with a primary key on ``key``.

    The insert is not one transaction across tasks; a failed batch is replayed
    and the key check leaves out what had already arrived.
    """

    url: str
    table: str
    key: str = "event_id"
    schema: T.StructType = field(default_factory=lambda: schemas.SINK_SCHEMA)
    prefer: Sequence[str] = ("event_time",)
    broadcast_limit: int = 1_000_000
    options: dict[str, str] = field(default_factory=dict)
    batch_size: int = 1000

    def prepare(self, spark: SparkSession) -> None:
        """Nothing to do: the table belongs to the database."""

    def read(self, spark: SparkSession) -> DataFrame:
        return read_jdbc(spark, self.url, self.table, **self.options)

    def writer_options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, "batchsize": str(self.batch_size), **self.options}

    def plan_insert(self, rows: DataFrame, facts: BatchFacts) -> Callable[[], int]:
        spark = rows.sparkSession
        # ingested_at is left to the table's own default.
        columns = T.StructType([f for f in self.schema.fields if f.name != "ingested_at"])
        order = [*self.prefer, *[c for c in columns.fieldNames() if c not in (self.key, *self.prefer)]]
        unstored = unseen(rows, self.read(spark), self.key, facts, self.broadcast_limit)
        new = to_sink_row(one_per_key(unstored, self.key, order), columns)

        def insert() -> int:
            # Counted and written from the same rows: a second key check after
            # the write would find every key stored.
            with cached(new) as rows_to_add:
                inserted = rows_to_add.count()
                if inserted:
                    rows_to_add.write.format("jdbc").options(**self.writer_options()).mode("append").save()
            return inserted

        return insert
