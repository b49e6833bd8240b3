"""What the physical plans must and must not contain."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from registered import all_entries
from registered.frames import films, table
from sievewell.operators import charts as CH
from sievewell.operators import cleaning as C
from sievewell.operators import ranking as R
from sievewell.operators import runs as RU
from sievewell.plans.skew import salted_lookup

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n, e in all_entries().items() if not n.startswith("stream_")])
def test_no_python_workers_no_cross_products(spark, name):
    text = plan(all_entries()[name].run(spark, SF_DIR))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_top_n_is_a_bounded_pass(spark):
    text = plan(R.rank_top(films(spark, SF_DIR), "revenue_musd"))
    assert "TakeOrderedAndProject(limit=13" in text
    assert text.count("FileScan") == 2


def test_all_rankings_read_once_and_limit_before_the_shuffle(spark):
    orders = table(spark, SF_DIR, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    specs = [R.RankSpec("a", "o_totalprice"), R.RankSpec("b", "o_custkey", ascending=True, floor=("o_totalprice", 10.0)), R.RankSpec("c", "o_custkey")]
    text = plan(R.rank_all(orders, specs, tie_break=["o_orderkey"]))
    assert text.count("FileScan") == 1
    partial, exchange = text.rindex("WindowGroupLimit"), text.rindex("Exchange hashpartitioning")
    assert "Partial" in text[partial:] and partial > exchange


def test_one_per_key_limits_before_the_shuffle(spark):
    text = plan(C.one_per_key(table(spark, SF_DIR, "lineitem"), "l_orderkey", ["l_linenumber"]))
    partial, exchange = text.rindex("WindowGroupLimit"), text.rindex("Exchange hashpartitioning")
    assert "Partial" in text[partial:] and partial > exchange


def test_filters_and_columns_reach_the_scan(spark):
    orders = R.eligible(table(spark, SF_DIR, "orders"), ("o_totalprice", 1000.0))
    text = plan(R.rank_top(orders.select("o_orderkey", "o_totalprice"), "o_totalprice", tie_break=["o_orderkey"]))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,1000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_nested_names_read_only_their_leaf(spark, tmp_path, raw_frame):
    from samples import record

    raw_frame(record(1)).write.parquet(str(tmp_path / "raw"))
    text = plan(C.flatten_arrays(spark.read.parquet(str(tmp_path / "raw")), ["genres"]).select("genres"))
    assert "ReadSchema: struct<genres:array<struct<name:string>>>" in text


def test_runs_put_bins_not_rows_in_sequence(spark):
    text = plan(RU.run_spans(table(spark, SF_DIR, "events"), "ts", gap_seconds=1800))
    window, aggregate = text.rindex("Window ["), text.rindex("HashAggregate")
    assert window < aggregate


def test_a_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = table(spark, SF_DIR, "events").select(F.lit("hot").alias("label"), "event_id", "value")
        coded = salted_lookup(points, CH.category_codes(points, "label"), ["label"], ["event_id"], salts=16)
        parts = coded.select(F.spark_partition_id().alias("p")).distinct().count()
        spread = points.select(F.pmod(F.xxhash64("event_id"), F.lit(16)).alias("s")).groupBy("s").count()
        assert coded.count() == points.count() and parts >= 1
        assert spread.count() == 16 and spread.agg(F.max("count")).first()[0] < points.count() / 8
        assert "__salt" in plan(coded)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
