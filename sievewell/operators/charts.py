"""Chart-ready datasets: CHT1-CHT5, PRJ27."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievewell.functions import expressions as X
from sievewell.operators.boxstats import box_stats
from sievewell.operators.summaries import keep_complete
from sievewell.plans.skew import salted_lookup

# Number of leading hex digits of the label hash; gives 4096 label buckets.
_BUCKET_DIGITS = 3


def category_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """PRJ27: distinct labels numbered densely from 0.

    Numbered within hash buckets, then shifted by the size of the buckets
    before: no task ever sorts all labels, and the offsets are at most 4096
    rows.  The order is (first hash digits, label).
    """
    labels = df.select(label).filter(F.col(label).isNotNull()).distinct()
    bucketed = labels.withColumn("__bucket", F.substring(F.md5(F.col(label).cast("binary")), 1, _BUCKET_DIGITS))
    sizes = bucketed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    place = F.row_number().over(W.partitionBy("__bucket").orderBy(label))
    return bucketed.join(F.broadcast(offsets), "__bucket").select(
        label, (F.col("__offset") + place - 1).cast("bigint").alias(code)
    )


def coded_points(
    df: DataFrame, x: str, y: str, group: str, complete: Sequence[str], extra: Sequence[str] = (), salts: int = 16
) -> DataFrame:
    """CHT1/CHT3: complete points with the first token of ``group`` as label and its code."""
    points = keep_complete(df, complete).select(
        *extra, x, y, X.first_token(F.col(group)).alias("label")
    )
    return salted_lookup(points, category_codes(points, "label"), ["label"], [x, y], salts)


def value_by_token(
    df: DataFrame, value: str, group: str, complete: Sequence[str], label: str = "label", **options: int
) -> DataFrame:
    """CHT2: box statistics of ``value`` by the first token of ``group``."""
    points = keep_complete(df, complete).select(value, X.first_token(F.col(group)).alias(label))
    return box_stats(points, label, value, **options)


def long_series(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """CHT4: one row per (ids, metric)."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def labelled_bars(df: DataFrame, flag: str, metrics: Sequence[str], yes: str, no: str) -> DataFrame:
    """CHT5: one row per (group label, metric)."""
    named = df.select(X.flag_label(F.col(flag), yes, no).alias("label"), *metrics)
    return long_series(named, ["label"], metrics)


def movie_charts(
    clean: DataFrame, comparison: DataFrame, yearly: DataFrame
) -> Mapping[str, DataFrame]:
    """The five chart datasets of the film catalogue preset."""
    complete = ("budget_musd", "revenue_musd", "roi")
    return {
        "revenue_vs_budget": coded_points(clean, "budget_musd", "revenue_musd", "production_companies", complete),
        "roi_by_genre": value_by_token(clean, "roi", "genres", complete, "primary_genre"),
        "popularity_vs_rating": coded_points(clean, "popularity", "vote_average", "production_companies", complete),
        "yearly_trends": long_series(yearly, ["release_year"], ["mean_budget_musd", "mean_revenue_musd"]),
        "franchise_vs_standalone": labelled_bars(
            comparison,
            "is_franchise",
            ["mean_revenue_musd", "mean_budget_musd", "mean_popularity", "mean_rating"],
            "Franchise",
            "Standalone",
        ),
    }
