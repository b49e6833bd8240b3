"""Logs that stay few files, and run summaries merged from increments."""

from __future__ import annotations

import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sievewell.operators.run_segments import RunStore
from sievewell.operators.runs import run_summary
from sievewell.sources.readers import read_log_csv
from sievewell.streaming.progress import PROGRESS_LOG_SCHEMA, RollingLog

SCHEMA = "stream_id string, batch_id bigint, timestamp timestamp, received bigint, inserted bigint, rejected bigint, batch_duration_ms bigint, processed_rows_per_second double"


def line(i, stream="s"):
    return (stream, i, "2024-01-01T00:00:00.000Z", i + 1, 1.5, 2.0, 7)


def test_a_thousand_appends_in_at_most_ten_files(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(1000):
        # A new object each time, as after a restart.
        (RollingLog(spark, path) if i % 100 == 0 else log).append([line(i)])
        log = RollingLog(spark, path)
    assert len([n for n in os.listdir(path) if n.endswith(".csv") and not n.startswith(".")]) <= 10
    assert sorted(r.batch_id for r in log.read().collect()) == list(range(1000))
    assert read_log_csv(spark, path, PROGRESS_LOG_SCHEMA).count() == 1000


def test_rows_survive_quotes_and_a_roll_that_was_cut_short(spark, tmp_path):
    path = tmp_path / "log"
    log = RollingLog(spark, str(path))
    assert log.read().count() == 0
    odd = ['a "quoted", name', "back\\slash", "", None, "é"]
    for i, name in enumerate(odd):
        log.append([line(i, name)])
    before = {r.batch_id: r.stream_id for r in log.read().collect()}
    assert [before[i] or None for i in range(5)] == [n or None for n in odd]
    # The wide file is there, but what it replaces has not been deleted yet.
    (path / "000000000001-000000000001.csv").write_text((path / log.files()[0]).read_text())
    assert sorted(r.batch_id for r in log.read().collect()) == list(range(5))
    log.append([line(5)])
    assert sorted(r.batch_id for r in read_log_csv(spark, str(path), PROGRESS_LOG_SCHEMA).collect()) == list(range(6))


def batches(rng, n):
    now, rows = datetime(2024, 1, 1), []
    for i in range(n):
        now += timedelta(seconds=rng.choice([0, 1, 5, 29, 30, 31, 90]))
        got = rng.randrange(50)
        rows.append((f"s{rng.randrange(3)}", i, now, 2 * got, got, got, rng.randrange(1, 900), rng.random() * 100))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_in_any_order_give_the_summary_of_the_whole_log(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = batches(rng, 160) + [("lone", 0, datetime(2024, 5, 1), 4, 3, 1, 10, 5.0), ("zero", 0, datetime(2024, 5, 1), 0, 0, 0, None, None)]
    whole = spark.createDataFrame(rows, SCHEMA)
    expected = {r.stream_id: r for r in run_summary(whole, whole, gap_seconds=30).collect()}
    store = RunStore(str(tmp_path / f"runs{seed}"), gap_seconds=30)
    parts = [rows[i::4] for i in range(4)]
    rng.shuffle(parts)
    for i, part in enumerate(parts):
        store.add(spark.createDataFrame(part, SCHEMA), f"p{i}")
    store.add(spark.createDataFrame(parts[0], SCHEMA), "p0")
    store.add(spark.createDataFrame([], SCHEMA), "none")
    store.add(spark.createDataFrame([("s0", 7, None, 1, 1, 0, 1, 1.0)], SCHEMA), "untimed")
    got = {r.stream_id: r for r in store.summary(spark).collect()}
    assert set(got) == set(expected)
    for stream, row in expected.items():
        assert list(got[stream].asDict()) == list(row.asDict())
        for name, a, b in zip(row.asDict(), row, got[stream]):
            assert a == b or math.isclose(a, b, rel_tol=1e-9), (stream, name, a, b)
    assert store.runs(spark).agg(F.sum("batches")).first()[0] == len(rows)
