from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewell.operators import ranking as R
from sievewell.operators import search as SE
from sievewell.plans import films as P

from samples import record


def numbered(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, m double")


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 30])
@pytest.mark.parametrize("top_n", [1, 5, 10])
def test_labels_agree_with_the_whole_input_count(spark, size, top_n):
    ranked = R.rank_top(numbered(spark, [float(v) for v in range(size)]), "m", top_n=top_n).collect()
    wanted = []
    for rank in range(1, min(size, top_n) + 1):
        label = "Top 3" if rank <= 3 else "Bottom 3" if size - rank < 3 else "Top 10"
        wanted.append((rank, label))
    assert [(r["rank"], r.rank_label) for r in ranked] == wanted


def test_order_ties_and_nulls(spark):
    df = numbered(spark, [None, 2.0, 5.0, 5.0, None, 1.0])
    assert [r.id for r in R.rank_top(df, "m").collect()] == [2, 3, 1, 5, 0, 4]
    assert [r.id for r in R.rank_top(df, "m", ascending=True).collect()] == [5, 1, 2, 3, 0, 4]
    assert [r.id for r in R.rank_top(df.repartition(4), "m", top_n=2).collect()] == [2, 3]


def test_unknown_metric_fails_while_planning(spark):
    with pytest.raises(KeyError):
        R.rank_top(numbered(spark, [1.0]), "no_such")


def test_ten_named_rankings_and_floors(raw_frame):
    table = P.clean_records(
        raw_frame(
            record(1), record(2, budget=1_000_000, revenue=90_000_000), record(3, budget=30_000_000), record(4, vote_count=3, vote_average=9.9)
        )
    )
    rankings = R.build_rankings(table)
    assert list(rankings) == [
        "highest_revenue", "highest_budget", "highest_profit", "lowest_profit", "highest_roi",
        "lowest_roi", "most_voted", "highest_rated", "lowest_rated", "most_popular",
    ]
    assert 2 not in [r.id for r in rankings["highest_roi"].collect()]
    assert 4 not in [r.id for r in rankings["highest_rated"].collect()]
    assert rankings["highest_revenue"].first().id == 2
    assert rankings["lowest_roi"].first().id == 3


@pytest.mark.parametrize("top_n", [1, 10])
def test_all_rankings_at_once_are_the_single_ones(spark, top_n):
    values = [3.0, None, float("nan"), -0.0, 0.0, 3.0, float("-inf"), float("inf"), -5.5, 7.0, 7.0, 1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([(i, v, i % 4, f"t{i}") for i, v in enumerate(values * 2)], "id long, m double, votes int, rank string").repartition(5)
    specs = [
        R.RankSpec("up", "m", ascending=True), R.RankSpec("down", "m"), R.RankSpec("few", "m", floor=("votes", 3)),
        R.RankSpec("none", "m", floor=("votes", 9)), R.RankSpec("whole", "votes", ascending=True, floor=("m", 6.0)),
    ]
    every = R.rank_all(df, specs, top_n=top_n).collect()
    for name, single in R.rank_by_specs(df, specs, top_n=top_n).items():
        got = sorted((r["rank"], r.id, str(r.m), r.rank_label) for r in every if r.ranking == name)
        assert got == [(r["rank"], r.id, str(r.m), r.rank_label) for r in single.collect()]
    assert every[0].asDict().keys() == {"ranking", "id", "m", "votes", "rank", "rank_label"}


def test_label_as_sql_function(spark):
    R.register_rank_label(spark)
    row = spark.sql("SELECT rank_label(1, 2) a, rank_label(5, 6) b, rank_label(5, 50) c").first()
    assert tuple(row) == ("Top 3", "Bottom 3", "Top 10")


def test_searches(raw_frame):
    table = P.clean_records(
        raw_frame(
            record(1, vote_average=5.0, people=["Ann Ash"]),
            record(2, vote_average=8.0, people=["Ann Ash", "Zed"]),
            record(3, genres=[{"id": 1, "name": "Comedy"}], people=["Ann Ash"]),
            record(4, runtime=80, people=["Ann Ash"], crew=[("Other", "Director")]),
            record(5, runtime=0, people=["Ann Ash"], vote_average=1.0),
            record(6, runtime=90, people=["Ann Ash"], vote_average=0.5),
        )
    )
    assert [r.id for r in P.best_rated_with(table, ["Science Fiction", "Comedy"], "Ann Ash").collect()] == [2, 4, 1, 5, 6]
    assert [r.id for r in P.directed_by_with(table, "Cy Cedar", "Ann Ash").collect()] == [6, 1, 2, 3, 5]
    assert SE.search(table, order=[F.col("id").desc()]).first().id == 6
