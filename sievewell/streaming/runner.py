"""Event folder to routed sink as one streaming query: SRC3, SRC4, STR1-STR9."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import Future
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sievewell import schemas
from sievewell.operators.validation import Rule, clean_events, contract_rules
from sievewell.sources.readers import csv_options
from sievewell.streaming.sink import BatchOutcome, RoutedSink

# Default pace of the stream.
TRIGGER_INTERVAL = "5 seconds"
FILES_PER_TRIGGER = 1


def event_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.RAW_EVENT_SCHEMA,
    files_per_trigger: int | None = FILES_PER_TRIGGER,
) -> DataFrame:
    """SRC3/SRC4/STR2: CSV files arriving in a folder, as text columns."""
    reader = csv_options(spark.readStream.schema(schema))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def first_arrivals(cleaned: DataFrame, key: str = "event_id") -> DataFrame:
    """Of valid rows the first per key over the life of the checkpoint; all other rows.

    Keys live in the query's state store, partitioned by key over the
    executors: a batch looks up its own keys only, as an index would, however
    large the table has grown.  Repeats do not reach the sink; a batch's
    ``received`` is then what arrived for the first time, and the progress
    log's ``num_input_rows`` is what was read.  Use the RocksDB provider
    (``spark.sql.streaming.stateStore.providerClass``) for large key sets.
    """
    once = F.when(F.col("is_valid"), F.col(key)).otherwise(F.expr("uuid()"))
    return cleaned.withColumn("__once", once).dropDuplicates(["__once"]).drop("__once")


@dataclass
class SinkWriter:
    """The foreachBatch function of a ``RoutedSink``.

    The stream id must live as long as the checkpoint: unless the caller names
    one it is the query id kept there, known once the query has started.
    An exception leaves ``foreachBatch`` and stops the query (STR9); a restart
    on the same checkpoint replays the batch.  ``last`` is the latest outcome;
    the sink's counts log has them all.
    """

    sink: RoutedSink
    stream_id: Future = field(default_factory=Future)
    last: BatchOutcome | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        outcome = self.sink.write_batch(batch, batch_id, self.stream_id.result(timeout=60))
        self.last = outcome or self.last


def routed_writer(cleaned: DataFrame, writer: SinkWriter, checkpoint: str) -> DataStreamWriter:
    """STR1/STR6: cleaned rows to the sink, append mode, checkpointed."""
    return cleaned.writeStream.foreachBatch(writer).outputMode("append").option("checkpointLocation", checkpoint)


def start_stream(
    spark: SparkSession,
    source: str | DataFrame,
    sink: RoutedSink,
    checkpoint: str,
    *,
    stream_id: str | None = None,
    once: bool = False,
    interval: str = TRIGGER_INTERVAL,
    files_per_trigger: int | None = FILES_PER_TRIGGER,
    rules: Sequence[Rule] | None = None,
    lenient_int: bool = False,
    state_partitions: int | None = None,
) -> tuple[StreamingQuery, SinkWriter]:
    """STR1, STR3, STR4: start the query; ``source`` is a folder or a raw event stream.

    ``rules`` are those of the sink's contract unless given; looser ones let a
    row through that stops the stream at the table.

    A table declared ``distinct_stream`` gets ``first_arrivals`` before it, its
    state in ``state_partitions`` parts (default: the session's shuffle
    partitions; a checkpoint keeps the number it was started with).
    """
    raw = event_stream(spark, source, files_per_trigger=files_per_trigger) if isinstance(source, str) else source
    sink.prepare(spark)
    writer = SinkWriter(sink)
    if stream_id is not None:
        writer.stream_id.set_result(stream_id)
    cleaned = clean_events(raw, contract_rules() if rules is None else rules, lenient_int=lenient_int, stamp=False)
    if getattr(sink.table, "distinct_stream", False):
        cleaned = first_arrivals(cleaned, sink.table.key)
    pending = routed_writer(cleaned, writer, checkpoint)
    pending = pending.trigger(availableNow=True) if once else pending.trigger(processingTime=interval)
    with _shuffle_partitions(spark, state_partitions):
        query = pending.start()
    if stream_id is None:
        writer.stream_id.set_result(str(query.id))
    return query, writer


@contextmanager
def _shuffle_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """A starting query takes the setting with it; the session gets its own back."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        if count is not None:
            spark.conf.set(name, str(count))
        yield
    finally:
        spark.conf.set(name, before)


def run_stream(
    spark: SparkSession,
    source: str | DataFrame,
    sink: RoutedSink,
    checkpoint: str,
    *,
    once: bool = False,
    duration: float | None = None,
    **options,
) -> tuple[StreamingQuery, SinkWriter]:
    """Run the stream: drain and stop (``once``), for ``duration`` seconds, or until it ends.

    A failure of the query is raised here.
    """
    query, writer = start_stream(spark, source, sink, checkpoint, once=once, **options)
    try:
        if once or duration is None:
            query.awaitTermination()
        else:
            query.awaitTermination(duration)
    finally:
        if query.isActive:
            query.stop()
    return query, writer
