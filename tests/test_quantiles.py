"""Exact quantiles and box statistics against plain sorting."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sievewell.functions.quantiles import grouped_quantiles
from sievewell.operators import summaries as S
from sievewell.operators.boxstats import box_stats

QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p0": 0.0, "p1": 1.0}


def disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(round(len(ordered) * p, 9))) - 1]


def cont(values, p):
    ordered = sorted(values)
    at = (len(ordered) - 1) * p
    low = math.floor(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def draws(seed):
    """A hot group with a third of all rows, ties, negatives, NULLs, a NULL key, an empty group."""
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(3000)]
    rows += [(None, float(rng.randint(-5, 5))) for _ in range(500)]
    rows += [(f"g{rng.randint(0, 9)}", rng.choice([None, rng.expovariate(0.01), 7.0, 7.0])) for _ in range(5000)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), ("none", None)]
    rows += [("same", 4.0)] * 400
    rng.shuffle(rows)
    return rows


def by_group(rows):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, [])
        if v is not None:
            groups[k].append(v)
    return groups


@pytest.mark.parametrize("method, plain", [("disc", disc), ("cont", cont)])
@pytest.mark.parametrize("options", [{}, {"accuracy": 100}, {"accuracy": 400, "few_groups": True}, {"accuracy": 100, "small_group": 1000}])
def test_agrees_with_sorting(spark, method, plain, options):
    rows = draws(11)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", QUANTILES, method=method, **options).collect()}
    wanted = by_group(rows)
    assert set(got) == set(wanted)
    for k, values in wanted.items():
        assert got[k].n == len(values)
        for name, p in QUANTILES.items():
            assert got[k][name] == (pytest.approx(plain(values, p), abs=1e-9) if values else None), (k, name)


def test_whole_frame_and_empty_frame(spark):
    values = [v for _, v in draws(5) if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = grouped_quantiles(df, [], "v", QUANTILES, accuracy=200).first()
    assert (row.n, row.median, row.q3) == (len(values), disc(values, 0.5), disc(values, 0.75))
    nothing = grouped_quantiles(df.limit(0), [], "v", QUANTILES).first()
    assert (nothing.n, nothing.median) == (0, None)
    assert grouped_quantiles(df.limit(0).withColumn("k", F.lit(1)), ["k"], "v", QUANTILES).count() == 0


def test_carried_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0, 10), ("a", 3.0, 20), ("b", None, 30)], "k string, v double, w int")
    got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", {"m": 0.5}, carry={"total": F.sum("w")}).collect()}
    assert (got["a"].m, got["a"].total, got["b"].m, got["b"].total) == (1.0, 30, None, 30)


def test_large_group_leaves_few_rows_for_the_last_step(spark):
    """The bracket, not the group, is what one task ranks."""
    df = spark.range(200_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    plan = grouped_quantiles(df, ["k"], "v", {"m": 0.5}, accuracy=10_000)
    assert plan.first().m == disc([i * 7919 % 200_003 for i in range(200_000)], 0.5)


def test_lower_median_is_an_element(spark):
    df = spark.createDataFrame([("x", float(v)) for v in range(1, 17)], "g string, v double")
    assert S.compare_by_presence(df, "g", {}, ("median", "v")).first().median == 8.0


def test_comparison_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("x", None, 1.0), (None, 2.0, 3.0)], "g string, v double, w double")
    rows = S.compare_by_presence(df, "g", {"mean_w": "w"}, ("median", "v"), "flag").collect()
    assert [(r.flag, r.mean_w, r.median) for r in rows] == [(True, 1.0, None), (False, 3.0, 2.0)]


@pytest.mark.parametrize("options", [{}, {"accuracy": 50}, {"accuracy": 300, "few_groups": True}])
def test_box_statistics(spark, options):
    rows = draws(23)
    df = spark.createDataFrame(rows + [("hot", float("nan"))], "k string, v double").repartition(4)
    got = {r.k: r for r in box_stats(df, "k", "v", **options).collect()}
    wanted = {k: v for k, v in by_group(rows).items() if v}
    assert set(got) == set(wanted)
    for k, values in wanted.items():
        q1, median, q3 = (cont(values, p) for p in (0.25, 0.5, 0.75))
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in values if low <= v <= high]
        row = got[k]
        assert (row.n, row.outliers) == (len(values), len(values) - len(inside))
        assert (row.q1, row["median"], row.q3) == pytest.approx((q1, median, q3))
        assert row.whisker_low == pytest.approx(min(min(inside), q1))
        assert row.whisker_high == pytest.approx(max(max(inside), q3))


@pytest.mark.parametrize("options", [{}, {"accuracy": 100, "small_group": 10}])
def test_integers_and_decimals_keep_their_last_digit(spark, options):
    from decimal import Decimal

    big = 9007199254740993
    small = spark.createDataFrame([(1, big), (1, big), (1, big + 2)], "k int, v bigint")
    assert [r.m for r in grouped_quantiles(small, ["k"], "v", {"m": 0.5}).collect()] == [big]
    values = sorted({big + (i * 7919) % 100_003 for i in range(4000)} | {2**63 - 1, -(2**63)})
    rows = spark.createDataFrame([(1, v, Decimal(v) / 100) for v in values], "k int, v bigint, d decimal(28,2)")
    median = values[(len(values) + 1) // 2 - 1]
    assert [r.m for r in grouped_quantiles(rows, ["k"], "v", {"m": 0.5}, **options).collect()] == [median]
    assert [r.m for r in grouped_quantiles(rows, ["k"], "d", {"m": 0.5}, **options).collect()] == [Decimal(median) / 100]
