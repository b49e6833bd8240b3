"""What is kept between runs (codes, sketches) and how hot keys are found."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewell.operators.codebook import CodeBook
from sievewell.operators.sketches import RANK_ERROR, SketchStore, merge_sketches, sketch_by, sketched_quantiles
from sievewell.plans.skew import hot_keys, salted_lookup
from sievewell.streaming.keyed_table import KeyedParquetTable
from sievewell.streaming.sink import RoutedSink


def labels(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "label string")


def codes(df):
    return {r.label: r.code for r in df.collect()}


def test_codes_stay_and_new_labels_go_on(spark, tmp_path):
    book = CodeBook(str(tmp_path / "codes"))
    assert codes(book.read(spark)) == {} and codes(book.add(labels(spark))) == {}
    first = codes(book.add(labels(spark, "a", "b", "b", None, "")))
    assert sorted(first) == ["", "a", "b"] and sorted(first.values()) == [0, 1, 2]
    assert codes(book.add(labels(spark, "b", None))) == first
    then = codes(book.add(labels(spark, *[f"n{i}" for i in range(50)], "a")))
    assert {k: then[k] for k in first} == first and sorted(then.values()) == list(range(53))


def test_a_part_that_broke_off_is_not_seen_and_written_over(spark, tmp_path):
    book = CodeBook(str(tmp_path / "codes"))
    first = codes(book.add(labels(spark, "a")))
    broken = tmp_path / "codes" / "part-000001"
    spark.createDataFrame([("x", 7)], "label string, code bigint").write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert codes(book.read(spark)) == first
    assert codes(book.add(labels(spark, "a", "y"))) == {"a": 0, "y": 1}


def test_sketches_merge_within_their_error(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 4).alias("period"), F.lit("g").alias("kind"), ((F.col("id") * 7919) % 40_000).cast("double").alias("x"))
    store = SketchStore(str(tmp_path / "s"), ("kind",))
    store.add(rows.where("period < 2"), "x")
    store.add(rows.where("period >= 2").unionAll(rows.where("period = 0")), "x")
    got = sketched_quantiles(merge_sketches(store.read(spark), ["kind"]), ["kind"], [0.0, 0.25, 0.5, 1.0]).collect()
    assert len(got) == 4 and {r.n for r in got} == {40_000}
    for r in got:
        assert abs(r.value / 40_000 - r.probability) <= RANK_ERROR


def test_sketches_of_odd_groups(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 3.0), (None, 5.0), (None, 4.0)], "kind string, x double")
    sketches = sketch_by(rows, ["kind"], "x")
    assert {r.kind: (r.n, r.sketch is None) for r in sketches.collect()} == {"a": (1, False), "b": (0, True), None: (3, False)}
    got = {r.kind: (r.n, r.value) for r in sketched_quantiles(merge_sketches(sketches, ["kind"]), ["kind"], [0.5]).collect()}
    assert got == {"a": (1, 1.0), None: (3, 4.0)}
    assert sketched_quantiles(merge_sketches(sketch_by(rows.limit(0), ["kind"], "x"), ["kind"]), ["kind"], [0.5]).count() == 0


def facts_with_hot_keys(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(9_000).select(F.col("id").alias("fact"), key.cast("int").alias("key"))


def test_only_hot_keys_are_named(spark):
    facts = facts_with_hot_keys(spark)
    hot = spark.range(1).select(hot_keys(facts, ["key"]).alias("hot")).first().hot
    want = {r[0] for r in spark.sql("SELECT xxhash64(7) UNION ALL SELECT xxhash64(CAST(NULL AS INT))").collect()}
    assert set(hot) == want
    assert not spark.range(1).select(hot_keys(facts.limit(0), ["key"]).alias("hot")).first().hot


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_with_copies_of_hot_keys_only(spark, how):
    facts = facts_with_hot_keys(spark)
    # The lookup's key is wider than the facts' key.
    lookup = spark.range(0, 8_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v")).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), -1L"))
    got = salted_lookup(facts, lookup, ["key"], ["fact"], how=how, only_hot=True)
    want = salted_lookup(facts, lookup, ["key"], ["fact"], how=how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("key = 7").count() == 3_000 and got.where("v = -1").count() == 3_000


def test_outcomes_need_a_column_of_the_table(tmp_path):
    with pytest.raises(ValueError, match="holds that column"):
        RoutedSink(KeyedParquetTable(str(tmp_path / "t")), str(tmp_path / "r"), str(tmp_path / "c"), outcomes_path=str(tmp_path / "o"), partition="tenant")
