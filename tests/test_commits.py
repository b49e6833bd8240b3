"""The commit log, the key index, and batches that fail on the way."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewell import schemas
from sievewell.operators import validation as V
from sievewell.streaming import commits
from sievewell.streaming.commits import CommitLog, Folder, read_counts
from sievewell.streaming.key_index import KeyIndex, filters, may_hold
from sievewell.streaming.keyed_table import KeyedParquetTable
from sievewell.streaming.sink import RoutedSink, read_rejects

from samples import event


def record(batch, stream="s", inserted=1):
    return {"stream_id": stream, "batch_id": batch, "received": 3, "inserted": inserted, "rejected": 0, "key_from": None, "key_to": None}


def test_rolled_records_are_read_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "ROLL_AT", 8)
    log = CommitLog(str(tmp_path / "log"))
    assert log.read(spark).collect() == [] and log.find(spark, "s", 0) is None
    # Empty batches leave no record.
    batches = [b for b in range(60) if b % 7 != 3]
    for b in batches:
        log.add(spark, record(b, inserted=b))
        assert log.find(spark, "s", b)["inserted"] == b
    log.add(spark, record(0, stream="t"))
    got = sorted((r.stream_id, r.batch_id, r.inserted) for r in read_counts(spark, log.path).collect())
    assert got == [("s", b, b) for b in batches] + [("t", 0, 1)]
    # Rolls, and the records of the last two of them.
    assert len(Folder(spark, f"{log.path}/s").names()) <= 60 // 8 + 2 * 8


def clean(event_frame, ids, **changes):
    return V.clean_events(event_frame(*[event(event_id=i, **changes) for i in ids]))


def sink_at(tmp_path, **options):
    return RoutedSink(KeyedParquetTable(str(tmp_path / "t"), **options), str(tmp_path / "r"), str(tmp_path / "c"))


@pytest.mark.parametrize("filter_from", [0, 10**9])
def test_keys_are_found_in_recent_batches_runs_and_merged_runs(spark, tmp_path, event_frame, filter_from):
    sink = sink_at(tmp_path, compact_at=2, filter_from=filter_from)
    sink.prepare(spark)
    index = sink.table.index()
    index.fan_in, index.keys_per_bucket = 2, 4
    stored, batch = set(), 0
    for round in range(7):
        ids = {f"{(round * 37 + i * 11) % 97:02d}" for i in range(20)}
        assert sink.write_batch(clean(event_frame, sorted(ids)), batch, "s").inserted == len(ids - stored)
        stored, batch = stored | ids, batch + 1
    state = index.load(spark)
    assert {r.level for r in state.runs} != {0} and len(state.recent) < 2
    assert sum(r.rows for r in state.runs) + sum(r["inserted"] for r in state.recent) == len(stored)
    # Another process goes on where this one ended.
    again = sink_at(tmp_path, compact_at=2, filter_from=filter_from)
    again.prepare(spark)
    assert again.write_batch(clean(event_frame, sorted(stored) + ["new"]), batch, "s").inserted == 1
    assert sorted(r.event_id for r in again.table.read(spark).collect()) == sorted(stored | {"new"})
    # And so it does without its index.
    Folder(spark, str(tmp_path / "t")).drop("_index")
    last = sink_at(tmp_path)
    last.prepare(spark)
    assert last.write_batch(clean(event_frame, sorted(stored) + ["newer"]), 0, "other").inserted == 1


def test_a_batch_opens_only_what_can_hold_its_keys(spark, tmp_path, event_frame):
    sink = sink_at(tmp_path, compact_at=4, filter_from=0)
    sink.prepare(spark)
    index = sink.table.index()
    index.keys_per_bucket = 5
    for b in range(5):
        sink.write_batch(clean(event_frame, [f"{'abcde'[b]}{i:02d}" for i in range(20)]), b, "s")
    run = index.load(spark).runs[0]
    assert run.buckets == 16 and (run.key_from, run.key_to) == ("a00", "d19")
    ask = lambda *ids: spark.createDataFrame([(i,) for i in ids], "key string")
    assert index.stored(spark, ask("z1", "z2"), "z1", "z2", ("s", 9)) is None
    one = index.stored(spark, ask("b07"), "b07", "b07", ("s", 9))
    assert len({f.rsplit("/", 2)[1] for f in one.inputFiles()}) == 1 and one.where("key = 'b07'").count() == 1
    # Only the latest batch's own file.
    assert len(index.stored(spark, ask("e03"), "e03", "e03", ("s", 9)).inputFiles()) == 1
    assert index.stored(spark, ask("e03"), "e03", "e03", ("s", 4)) is None


def test_filters_hold_all_their_keys_and_few_others(spark):
    keys = spark.range(3000).select((F.col("id") % 3).cast("int").alias("bucket"), F.col("id").cast("string").alias("key"))
    blooms = filters(keys, 256)
    assert keys.join(blooms, "bucket").where(may_hold(F.col("filter"), F.col("key"))).count() == 3000
    others = spark.range(10_000, 40_000).select((F.col("id") % 3).cast("int").alias("bucket"), F.col("id").cast("string").alias("key"))
    assert others.join(blooms, "bucket").where(may_hold(F.col("filter"), F.col("key"))).count() < 0.02 * 30_000


def test_a_batch_that_fails_before_its_commit_is_not_seen(spark, tmp_path, event_frame, monkeypatch):
    shape = V.clean_events(event_frame()).schema
    sink = sink_at(tmp_path)
    sink.prepare(spark)
    seen = lambda: (
        sorted(r.event_id for r in sink.table.read(spark).collect()), read_rejects(spark, sink.rejects_path, shape, sink.counts_path).count(),
        read_counts(spark, sink.counts_path).count(),
    )
    sink.write_batch(clean(event_frame, ["a"]).unionByName(clean(event_frame, ["r"], price="0")), 0, "s")
    before = seen()
    assert before == (["a"], 1, 1)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sink.write_batch(clean(event_frame, ["b", "c"]).unionByName(clean(event_frame, ["d"], price="-1")), 1, "s")
    assert (tmp_path / "t" / "stream_id=s" / "batch_id=1").exists() and seen() == before
    # What the failed attempt left of rejects does not come back with a retry that has none.
    assert sink.write_batch(clean(event_frame, ["b", "d"]), 1, "s").inserted == 2
    assert seen() == (["a", "b", "d"], 1, 2)
    # Another stream's failed batch stores nothing either.
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sink.write_batch(clean(event_frame, ["x"]), 0, "t")
    assert sink.write_batch(clean(event_frame, ["x"]), 2, "s").inserted == 1


def test_a_committed_batch_is_left_as_it_is(spark, tmp_path, event_frame):
    sink = sink_at(tmp_path)
    sink.prepare(spark)
    first = sink.write_batch(clean(event_frame, ["a", "b"]), 0, "s")
    assert sink.write_batch(clean(event_frame, ["c"]), 0, "s") == first
    assert schemas.SINK_SCHEMA.fieldNames() + ["stream_id", "batch_id"] == sink.table.read(spark).columns
    assert sorted(r.event_id for r in sink.table.read(spark).collect()) == ["a", "b"]
