from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sievewell.operators import runs as R
from sievewell.plans.performance import run_report

START = dt.datetime(2024, 1, 1)


def stamps(spark, seconds, kind="timestamp_ntz"):
    rows = [(s, i, START + dt.timedelta(seconds=t)) for i, (s, t) in enumerate(seconds)]
    return spark.createDataFrame(rows, f"s string, i int, t {kind}")


def plain_runs(times, gap):
    run, before, out = 0, None, []
    for t in times:
        if before is None or t - before > gap:
            run += 1
        out.append(run)
        before = t
    return out


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_gap_must_be_longer_than_the_limit(spark, kind):
    df = stamps(spark, [("a", t) for t in (0, 30, 60.000001, 91, 91, 120)], kind)
    got = [r.run_id for r in R.assign_runs(df, "t").orderBy("t").collect()]
    assert got == [1, 1, 2, 3, 3, 3]
    assert sorted(r.i for r in R.latest_run(df, "t").collect()) == [3, 4, 5]


def test_runs_per_key_agree_with_a_sequential_scan(spark):
    rng = random.Random(4)
    seconds = []
    for key in "abc":
        t = rng.random() * 100
        for _ in range(300):
            t += rng.choice([0, 0.5, 5, 29.9, 30, 30.1, 45, 200])
            seconds.append((key, round(t, 3)))
    df = stamps(spark, seconds)
    got = {r.i: r.run_id for r in R.assign_runs(df, "t", keys=["s"]).collect()}
    last = {r.i for r in R.latest_run(df, "t", keys=["s"]).collect()}
    for key in "abc":
        mine = [(i, t) for i, (s, t) in enumerate(seconds) if s == key]
        wanted = plain_runs([t for _, t in mine], 30)
        assert [got[i] for i, _ in mine] == wanted
        assert {i for i, _ in mine} & last == {i for (i, _), w in zip(mine, wanted) if w == wanted[-1]}
    spans = R.run_spans(df, "t", keys=["s"]).agg(F.sum("n").alias("n"), F.count("*").alias("runs")).first()
    assert (spans.n, spans.runs) == (900, sum(max(plain_runs([t for s, t in seconds if s == k], 30)) for k in "abc"))


def test_empty_and_null_times(spark):
    df = stamps(spark, [("a", 1)]).withColumn("t", F.lit(None).cast("timestamp_ntz"))
    assert R.latest_run(df, "t").count() == 0
    assert R.assign_runs(df, "t").first().run_id is None
    assert R.assign_runs(df.limit(0), "t").count() == 0


PROGRESS = "stream_id string, batch_id bigint, timestamp string, num_input_rows bigint, processed_rows_per_second double, batch_duration_ms bigint"
COUNTS = "stream_id string, batch_id bigint, received bigint, inserted bigint, rejected bigint"


def logs(spark, batches):
    """batches: (stream, batch id, seconds, rows, rows/s, ms, inserted)."""
    progress = [
        (s, b, (START + dt.timedelta(seconds=t)).isoformat(timespec="milliseconds") + "Z", n, rate, ms)
        for s, b, t, n, rate, ms, _ in batches
    ]
    counts = [(s, b, n, ok, n - ok) for s, b, _, n, _, _, ok in batches if n]
    rejects = [(s, b, f"r{j % 2}") for s, b, n, ok in [(x[0], x[1], x[3], x[6]) for x in batches] for j in range(n - ok)]
    return (
        spark.createDataFrame(progress, PROGRESS),
        spark.createDataFrame(counts, COUNTS),
        spark.createDataFrame(rejects, "stream_id string, batch_id bigint, validation_reason string"),
    )


def test_report_of_the_latest_run(spark):
    # Batch ids of the last run repeat those of an earlier stream.
    batches = [
        ("old", 0, 0, 10, 5.0, 9000, 9), ("old", 1, 5, 10, 5.0, 9000, 9),
        ("new", 0, 100, 50, 10.0, 3000, 40), ("new", 1, 105, 0, 0.0, 10, 0),
        ("new", 2, 200, 20, 10.0, 2000, 18), ("new", 3, 205, 20, 40.0, 500, 19), ("new", 4, 210, 20, 20.0, 1000, 20),
    ]
    report = run_report(*logs(spark, batches))
    row = {r.stream_id: r for r in report["summary"].collect()}["new"]
    assert (row.batches, row.received, row.inserted, row.rejected, row.mean_received) == (3, 60, 57, 3, 20.0)
    assert (row.mean_latency_s, row.min_latency_s, row.max_latency_s, row.mean_rows_per_second) == (0.75, 0.5, 1.0, 30.0)
    assert (row.inserted_share, row.rejected_share) == (0.95, 0.05)
    detail = [(r.batch_id, r.received, r.seconds) for r in report["detail"].filter("stream_id = 'new'").orderBy("batch_id").collect()]
    assert detail == [(2, 20, 2.0), (3, 20, 0.5), (4, 20, 1.0)]
    assert report["latency"].filter("stream_id = 'new'").count() == 3
    assert report["outcomes"].filter("stream_id = 'new'").agg(F.sum("value")).first()[0] == 60
    # 2 + 1 rejects of the new run's latest batches, 1 + 1 of the old stream.
    assert {r.validation_reason: r.n for r in report["reasons"].collect()} == {"r0": 4, "r1": 1}


def test_single_batch_and_empty_logs(spark):
    one = run_report(*logs(spark, [("s", 7, 0, 4, 2.0, 2000, 4)]))["summary"].first()
    assert (one.mean_latency_s, one.mean_rows_per_second, one.batches) == (2.0, 0.0, 1)
    progress, counts, rejects = logs(spark, [("s", 7, 0, 4, 2.0, 2000, 4)])
    empty = run_report(progress.limit(0), counts.limit(0), rejects.limit(0))
    assert all(empty[name].count() == 0 for name in empty)
    unkeyed = run_report(progress.limit(0), counts.limit(0), rejects.limit(0), keys=[])["summary"].first()
    assert (unkeyed.batches, unkeyed.received, unkeyed.mean_received, unkeyed.mean_rows_per_second) == (0, 0, 0.0, 0.0)
