"""Real streams over folders of event files."""

from __future__ import annotations

import itertools
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sievewell import schemas
from sievewell.operators import validation as V
from sievewell.operators.runs import with_rows_read
from sievewell.plans.performance import run_report
from sievewell.sources.readers import read_log_csv
from sievewell.streaming.keyed_table import BatchFacts, JdbcTable, KeyedParquetTable, check_stream_id
from sievewell.streaming.progress import PROGRESS_LOG_SCHEMA, ProgressRecorder, progress_frame
from sievewell.streaming.runner import event_stream, run_stream, start_stream
from sievewell.streaming.sink import ContractViolation, RoutedSink, partition_counts, read_counts, read_rejects

from samples import event

HEADER = ",".join(schemas.EVENT_COLUMNS)


def line(i, **changes):
    e = event(event_id=f"e{i:04d}", **changes)
    return ",".join("" if e[c] is None else e[c] for c in schemas.EVENT_COLUMNS)


_clock = itertools.count(int(time.time()) - 3600)


def drop_file(folder, name, *lines):
    """A finished event file; the source takes files by age, so ages must differ."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
    age = next(_clock)
    os.utime(folder / name, (age, age))


@pytest.fixture
def sink(tmp_path):
    return RoutedSink(KeyedParquetTable(str(tmp_path / "events")), str(tmp_path / "rejects"), str(tmp_path / "counts"))


def stored_ids(spark, sink):
    return sorted(r.event_id for r in sink.table.read(spark).collect())


def counts(spark, sink):
    rows = read_counts(spark, sink.counts_path).orderBy("stream_id", "batch_id").collect()
    return [(r.stream_id, r.batch_id, r.received, r.inserted, r.rejected) for r in rows]


def rejects(spark, sink):
    shape = V.clean_events(spark.createDataFrame([], schemas.RAW_EVENT_SCHEMA)).schema
    return {r.validation_reason: r.n for r in read_rejects(spark, sink.rejects_path, shape).groupBy("validation_reason").agg(F.count("*").alias("n")).collect()}


def test_drain_restart_and_lost_checkpoint(spark, sink, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    drop_file(inbox, "1.csv", line(1), line(2, price="-1"), line(3) + ",extra", line(4, event_type=""))
    drop_file(inbox, "2.csv", line(5), line(5), line(1), "e0099,too,short")
    run = dict(once=True, rules=V.contract_rules())
    query, writer = run_stream(spark, str(inbox), sink, checkpoint, **run)
    first = str(query.id)
    assert stored_ids(spark, sink) == ["e0001", "e0005"]
    assert sorted(c[2:] for c in counts(spark, sink)) == [(4, 1, 1), (4, 1, 3)]
    assert {c[0] for c in counts(spark, sink)} == {first}
    assert rejects(spark, sink) == {"invalid_price": 1, "corrupt_csv_row": 2, "invalid_event_type": 1}
    assert [(o.batch_id, o.inserted) for o in read_counts(spark, sink.counts_path).orderBy("batch_id").collect()] == [(0, 1), (1, 1)]

    # The source is read once per batch.
    assert progress_frame(spark, query.recentProgress).agg(F.sum("num_input_rows")).first()[0] == 8

    # Same checkpoint: only the new file, under the same stream id.
    drop_file(inbox, "3.csv", line(6))
    again, _ = run_stream(spark, str(inbox), sink, checkpoint, **run)
    assert str(again.id) == first
    assert stored_ids(spark, sink) == ["e0001", "e0005", "e0006"]

    # Lost checkpoint: everything comes again, batch ids restart, nothing is lost or doubled.
    before = sink.table.read(spark).select("event_id", "stream_id", "batch_id").collect()
    run_stream(spark, str(inbox), sink, str(tmp_path / "cp2"), **run)
    assert sorted(before) == sorted(sink.table.read(spark).select("event_id", "stream_id", "batch_id").collect())
    assert sum(c[3] for c in counts(spark, sink) if c[0] != first) == 0


def test_replayed_batch_leaves_table_counts_and_rejects_alone(spark, sink, event_frame):
    rows = [event(event_id=i, quantity=q) for i, q in [("a", "1"), ("a", "1"), ("b", "2"), ("c", "-2"), ("d", "x")]]
    batch = V.clean_events(event_frame(*rows)).repartition(3)
    sink.prepare(spark)
    one = sink.write_batch(batch, 0, "s")
    assert (one.received, one.inserted, one.rejected) == (5, 2, 2)
    assert sink.write_batch(batch, 0, "s") == one
    other = sink.write_batch(batch, 1, "s")
    assert (other.inserted, other.rejected) == (0, 2)
    assert stored_ids(spark, sink) == ["a", "b"]
    assert counts(spark, sink) == [("s", 0, 5, 2, 2), ("s", 1, 5, 0, 2)]
    per_part = partition_counts(batch).agg(F.sum("received"), F.sum("valid"), F.sum("rejected")).first()
    assert tuple(per_part) == (5, 3, 2)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_key_check_with_and_without_broadcast(spark, tmp_path, event_frame, limit):
    table = KeyedParquetTable(str(tmp_path / "t"), broadcast_limit=limit, rows_per_file=max(limit, 10))
    sink = RoutedSink(table, str(tmp_path / "r"), str(tmp_path / "c"))
    sink.prepare(spark)
    frames = [event_frame(*[event(event_id=f"e{i:03d}") for i in span]) for span in (range(50), range(25, 75))]
    got = [sink.write_batch(V.clean_events(f), i, "s").inserted for i, f in enumerate(frames)]
    assert got == [50, 25]
    assert len(stored_ids(spark, sink)) == 75


def test_all_valid_none_valid_and_empty_batches(spark, sink, event_frame):
    sink.prepare(spark)
    assert sink.write_batch(V.clean_events(event_frame(event()).limit(0)), 0, "s") is None
    assert sink.write_batch(V.clean_events(event_frame(event(price="0"))), 1, "s").rejected == 1
    assert sink.write_batch(V.clean_events(event_frame(event())), 2, "s").inserted == 1
    assert [c[1] for c in counts(spark, sink)] == [1, 2]
    assert rejects(spark, sink) == {"invalid_price": 1}


def test_sink_types_and_stamp(spark, sink, event_frame):
    sink.prepare(spark)
    sink.write_batch(V.clean_events(event_frame(event(price="2.005"))), 0, "s")
    stored = sink.table.read(spark)
    assert [f.name for f in stored.schema] == [*schemas.SINK_SCHEMA.fieldNames(), "stream_id", "batch_id"]
    row = stored.first()
    assert str(row.price) in ("2.01", "2.00") and row.ingested_at is not None and row.processing_time is not None


def test_valid_row_outside_the_contract_stops_the_stream(spark, sink, tmp_path):
    inbox = tmp_path / "in"
    drop_file(inbox, "1.csv", line(1), line(2, event_type=""))
    with pytest.raises(StreamingQueryException, match="sink contract"):
        run_stream(spark, str(inbox), sink, str(tmp_path / "cp"), once=True, rules=V.event_rules())
    assert stored_ids(spark, sink) == []
    # After the rules are mended, the restart replays the batch.
    run_stream(spark, str(inbox), sink, str(tmp_path / "cp"), once=True, rules=V.contract_rules())
    assert stored_ids(spark, sink) == ["e0001"]


def test_contract_violation_names_the_rule(spark, sink, event_frame):
    sink.prepare(spark)
    with pytest.raises(ContractViolation, match="missing_category"):
        sink.write_batch(V.clean_events(event_frame(event(category=" "))), 0, "s")


def test_first_arrivals_keep_repeats_out_by_state(spark, tmp_path):
    table = KeyedParquetTable(str(tmp_path / "t"), distinct_stream=True)
    sink = RoutedSink(table, str(tmp_path / "r"), str(tmp_path / "c"))
    inbox = tmp_path / "in"
    drop_file(inbox, "1.csv", line(1), line(1), line(2), line(3, price="0"), line(3, price="0"))
    drop_file(inbox, "2.csv", line(2), line(4), line(3, price="0"))
    run = dict(once=True, rules=V.contract_rules())
    query, _ = run_stream(spark, str(inbox), sink, str(tmp_path / "cp"), stream_id="one", **run)
    assert stored_ids(spark, sink) == ["e0001", "e0002", "e0004"]
    assert sorted(c[2:] for c in counts(spark, sink)) == [(2, 1, 1), (4, 2, 2)]
    progress = progress_frame(spark, query.recentProgress, "one")
    read = with_rows_read(read_counts(spark, sink.counts_path), progress).orderBy("batch_id").collect()
    assert [(r.received, r.inserted, r.rejected, r.repeats) for r in read] == [(5, 2, 2, 1), (3, 1, 1, 1)]
    # A new checkpoint has no state; rows of the earlier stream are then compared.
    drop_file(inbox, "3.csv", line(5))
    run_stream(spark, str(inbox), sink, str(tmp_path / "cp2"), stream_id="two", **run)
    assert stored_ids(spark, sink) == ["e0001", "e0002", "e0004", "e0005"]


def test_timed_run_and_listener(spark, sink, tmp_path):
    inbox, log = tmp_path / "in", str(tmp_path / "progress")
    drop_file(inbox, "1.csv", line(1), line(2))
    recorder = ProgressRecorder(spark, log, stream_id="live")
    spark.streams.addListener(recorder)
    try:
        query, _ = run_stream(
            spark, str(inbox), sink, str(tmp_path / "cp"), stream_id="live", duration=15, interval="200 milliseconds", rules=V.contract_rules()
        )
        assert not query.isActive
        assert recorder.wait_ended()
    finally:
        spark.streams.removeListener(recorder)
    assert recorder.flush() == 0
    progress = read_log_csv(spark, log, PROGRESS_LOG_SCHEMA)
    shape = V.clean_events(spark.createDataFrame([], schemas.RAW_EVENT_SCHEMA)).schema
    summary = run_report(progress, read_counts(spark, sink.counts_path), spark.createDataFrame([], shape).withColumns({"stream_id": F.lit("x"), "batch_id": F.lit(1)}))["summary"].first()
    assert (summary.stream_id, summary.batches, summary.received, summary.inserted) == ("live", 1, 2, 2)
    assert summary.mean_latency_s > 0


def test_every_batch_of_a_long_query_is_logged_once(spark, tmp_path):
    log = str(tmp_path / "log")
    recorder = ProgressRecorder(spark, log, flush_every=60)

    class Ended:
        exception, id = None, "q"

    class Progress:
        def __init__(self, batch):
            self.progress = {
                "id": "q", "batchId": batch, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": batch % 3,
                "inputRowsPerSecond": 1.0, "processedRowsPerSecond": 1.0, "durationMs": {"triggerExecution": 5},
            }

    for batch in range(230):
        recorder.onQueryProgress(Progress(batch))
    recorder.onQueryTerminated(Ended())
    assert recorder.wait_ended(1)
    got = sorted(r.batch_id for r in read_log_csv(spark, log, PROGRESS_LOG_SCHEMA).collect())
    assert got == [b for b in range(230) if b % 3]


def test_stream_options(spark, sink, tmp_path):
    inbox = tmp_path / "in"
    for i in range(3):
        drop_file(inbox, f"{i}.csv", line(i))
    stream = event_stream(spark, str(inbox))
    assert stream.isStreaming and stream.schema == schemas.RAW_EVENT_SCHEMA
    query, writer = start_stream(spark, str(inbox), sink, str(tmp_path / "cp"), once=True, files_per_trigger=2, stream_id="o")
    query.awaitTermination()
    assert [o.received for o in read_counts(spark, sink.counts_path).orderBy("batch_id").collect()] == [2, 1]


def test_stream_id_becomes_a_folder():
    for bad in ("a/b", "", "x=1", "../up"):
        with pytest.raises(ValueError):
            check_stream_id(bad)


def test_database_table_writes_unseen_rows_only(spark, event_frame, monkeypatch):
    """The JDBC calls themselves need a database and are replaced here."""
    written = []
    table = JdbcTable("jdbc:none:", "events", options={"user": "u"})
    stored = spark.createDataFrame([("b",)], "event_id string")
    monkeypatch.setattr(JdbcTable, "read", lambda self, spark: stored)
    from pyspark.sql.readwriter import DataFrameWriter

    def fake_save(self, *a, **k):
        written.extend(self._df.collect())

    monkeypatch.setattr(DataFrameWriter, "save", fake_save)
    rows = V.clean_events(event_frame(event(event_id="a"), event(event_id="a"), event(event_id="b"), event(event_id="c")))
    assert table.plan_insert(rows, BatchFacts("s", 0, 4, "a", "c"))() == 2
    assert sorted(r.event_id for r in written) == ["a", "c"]
    assert tuple(written[0].asDict()) == schemas.SINK_COLUMNS
    assert table.writer_options() == {"url": "jdbc:none:", "dbtable": "events", "batchsize": "1000", "user": "u"}
