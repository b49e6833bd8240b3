from __future__ import annotations

from pyspark.sql import functions as F

from sievewell.operators import merge as M
from sievewell.plans.skew import salted_lookup

KV = "id bigint, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def test_request_resolution(spark):
    requested = M.request_list(spark, [3, 0, 9, -1, 1, 3])
    cache, fresh = frame(spark, (1, "old1"), (3, "old3"), (4, "only cached")), frame(spark, (3, "new3"))
    wanted = M.usable_requests(requested)
    assert [r.id for r in wanted.orderBy("position").collect()] == [3, 9, 1, 3]
    assert [r.id for r in M.missing_keys(wanted, cache).collect()] == [9]
    known = M.merge_fresh(cache, fresh)
    assert {r.id: r.v for r in known.collect()} == {1: "old1", 3: "new3", 4: "only cached"}
    assert [r.v for r in M.lookup_in_order(wanted, known).collect()] == ["new3", "old1", "new3"]
    sample = frame(spark, (7, "sample"))
    whole = M.resolve_requests(requested, cache, fresh, sample)
    assert [r.v for r in whole.orderBy("position").collect()] == ["new3", "old1", "new3"]
    nothing = frame(spark)
    assert [r.v for r in M.resolve_requests(requested, nothing, nothing, sample).collect()] == ["sample"]


def test_one_row_per_key_and_no_fallback_for_nothing(spark):
    requested, cache = M.request_list(spark, [5, 6]), frame(spark, (6, "b"), (6, "a"), (7, "x"), (7, "x"))
    fresh, sample, nothing = frame(spark, (5, "z"), (5, "y")), frame(spark, (9, "sample")), frame(spark)
    got = M.resolve_requests(requested, cache, fresh, sample).orderBy("position").collect()
    assert [(r.position, r.id, r.v) for r in got] == [(0, 5, "y"), (1, 6, "a")]
    assert sorted(tuple(r) for r in M.merge_fresh(cache, fresh).collect()) == [(5, "y"), (6, "a"), (7, "x")]
    assert M.resolve_requests(M.request_list(spark, [0, -3]), nothing, nothing, sample).count() == 0


def test_fallback(spark):
    some, none, other = frame(spark, (1, "a")), frame(spark), frame(spark, (2, "b"))
    assert [r.v for r in M.with_fallback(some, other).collect()] == ["a"]
    assert [r.v for r in M.with_fallback(none, other).collect()] == ["b"]
    assert "Cartesian" not in plan(M.with_fallback(some, other)) and "NestedLoop" not in plan(M.with_fallback(some, other))


def test_latest_fresh_row_wins(spark):
    fresh = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id bigint, v string, at int")
    merged = M.merge_fresh(frame(spark, (1, "old"), (2, "kept")), fresh, latest=[F.col("at").desc()])
    assert {r.id: r.v for r in merged.collect()} == {1: "y", 2: "kept"}


def test_salted_lookup_equals_a_plain_join_with_a_hot_and_a_null_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
            F.col("id").alias("x"),
        )
        lookup = facts.select("k").distinct().withColumn("tag", F.concat(F.lit("t"), F.coalesce("k", F.lit("null"))))
        for few in (False, True):
            joined = salted_lookup(facts, lookup, ["k"], ["x"], salts=7, few_keys=few)
            assert joined.columns == ["k", "x", "tag"]
            assert joined.count() == 3000
            assert joined.filter(F.col("tag") != F.concat(F.lit("t"), F.coalesce("k", F.lit("null")))).count() == 0
        left = salted_lookup(facts, lookup.filter("k = 'hot'"), ["k"], ["x"], how="left")
        assert (left.count(), left.filter("tag is not null").count()) == (3000, 1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
