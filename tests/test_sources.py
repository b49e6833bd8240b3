from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sievewell import schemas
from sievewell.plans import films as P
from sievewell.plans import scratch
from sievewell.sources import readers as RD
from sievewell.sources import writers as WR

from samples import event, record


def test_ndjson_round_trip_with_absent_and_null_fields(spark, raw_frame, tmp_path):
    raw = raw_frame(record(1), record(2, belongs_to_collection=None, credits=None), {"id": 3, "title": "T", "status": "Released"})
    folder = WR.write_ndjson(raw, str(tmp_path / "nd"))
    back = RD.read_ndjson(spark, folder)
    assert back.schema == schemas.RAW_RECORD_SCHEMA
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.collect()))


def test_all_null_struct_column_keeps_its_type(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([record(1, belongs_to_collection=None), record(2, belongs_to_collection=None)]))
    clean = P.clean_records(RD.read_json_document(spark, str(tmp_path / "a.json")))
    assert [r.belongs_to_collection for r in clean.collect()] == [None, None]


def test_event_files_mark_rows_of_the_wrong_width(spark, tmp_path):
    e = event()
    good = ",".join(e[c] for c in schemas.EVENT_COLUMNS)
    (tmp_path / "e.csv").write_text("\n".join([",".join(schemas.EVENT_COLUMNS), good, good + ",more", "only,three,fields"]) + "\n")
    df = RD.read_event_csv(spark, str(tmp_path / "e.csv"))
    # The verdict does not depend on the columns asked for.
    for columns in (df.columns, ["event_id", "_corrupt_record"], ["quantity", "_corrupt_record"]):
        assert [r._corrupt_record is not None for r in df.select(*columns).collect()] == [False, True, True]


def test_log_scan_checks_its_header(spark, tmp_path):
    path = tmp_path / "counts.csv"
    path.write_text("received,batch_id,inserted,rejected,spare\n5,1,3,2,x\n7,2,oops,0,y\n")
    rows = RD.read_log_csv(spark, str(path), schemas.COUNTS_SCHEMA).orderBy("batch_id").collect()
    assert [tuple(r) for r in rows] == [(1, 5, 3, 2), (2, 7, None, 0)]
    path.write_text("1,5,3,2\n2,7,7,0\n")
    with pytest.raises(ValueError, match="batch_id"):
        RD.read_log_csv(spark, str(path), schemas.COUNTS_SCHEMA)
    (tmp_path / "empty.csv").write_text("")
    assert RD.read_log_csv(spark, str(tmp_path / "empty.csv"), schemas.COUNTS_SCHEMA).count() == 0


def test_reject_files_tell_their_batch_by_name(spark, tmp_path):
    for name, reasons in {
        "rejected_batch_3_part_0.csv": ["a", "b"], "rejected_batch_3_part_1.csv": ["a"], "rejected_batch_12.csv": ["c"], "other.csv": ["z"],
    }.items():
        (tmp_path / name).write_text("validation_reason\n" + "\n".join(reasons) + "\n")
    schema = schemas.struct_of(validation_reason="string")
    got = RD.read_reject_csv(spark, str(tmp_path / "*.csv"), schema).groupBy("batch_id").agg(F.sort_array(F.collect_list("validation_reason")).alias("r"))
    assert {r.batch_id: r.r for r in got.collect()} == {3: ["a", "a", "b"], 12: ["c"]}


def test_single_csv_is_one_file_with_a_header(spark, tmp_path):
    folder = WR.write_single_csv(spark.range(100).repartition(5), str(tmp_path / "one"))
    files = list((tmp_path / "one").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "id"
    assert spark.read.option("header", True).csv(folder).count() == 100
    assert spark.read.parquet(WR.write_table(spark.range(10), str(tmp_path / "t"))).count() == 10


def test_report_bundle_keeps_order_and_limits(spark):
    df = spark.range(20).select("id", F.lit(None).cast("string").alias("note"))
    bundle = WR.report_bundle(
        [WR.section("Top", df, [F.col("id").desc()], 3), WR.section("All", df.limit(2), [F.col("id")], None)]
    ).collect()
    top = [r.row_json for r in sorted((r for r in bundle if r.section == "Top"), key=lambda r: r.position)]
    assert top == ['{"id":19,"note":null}', '{"id":18,"note":null}', '{"id":17,"note":null}']
    assert sum(r.section == "All" for r in bundle) == 2


def test_whole_batch_preset(spark, raw_frame):
    raw = raw_frame(*[record(i, budget=(i + 10) * 1_000_000, release_date=f"20{10 + i % 3}-01-01") for i in range(1, 15)])
    with scratch.cached(P.clean_records(raw)) as clean:
        results = P.run_batch(raw, clean=clean)
        assert {"clean", "highest_roi", "search_best_rated", "franchise_vs_standalone", "yearly_trends", "report", "chart_roi_by_genre"} <= set(results)
        assert results["chart_revenue_vs_budget"].count() == 14
        sections = {r.section: r.n for r in results["report"].groupBy("section").agg(F.count("*").alias("n")).collect()}
        assert sections["highest_revenue"] == 5 and sections["yearly_trends"] == 3
        assert results["director_summary"].first().movie_count == 14


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.scratch_path(spark, "x")
    assert path != scratch.scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured)
    cut = scratch.materialized(spark.range(5), "cut")
    assert cut.count() == 5 and "Scan" in cut._jdf.queryExecution().executedPlan().toString()
