"""Box-plot statistics per category: AGG12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell.functions.quantiles import LINEAR, grouped_quantiles
from sievewell.operators.summaries import keep_complete
from sievewell.plans.skew import salted_lookup

# Fixed value: whisker reach in interquartile ranges.
WHISKER_REACH = 1.5


def box_stats(
    df: DataFrame,
    category: str,
    value: str,
    *,
    reach: float = WHISKER_REACH,
    salts: int = 16,
    few_groups: bool = False,
    **quantile_options: int,
) -> DataFrame:
    """Per category: n, quartiles (linear), whisker ends, number of outliers.

    Whiskers end at the outermost values within ``reach`` interquartile ranges
    of the box, or at the box itself when there is none beyond it.  NULL and
    NaN values are left out; a category without values does not appear.
    """
    points = keep_complete(df.select(category, F.col(value).cast("double").alias("__x")), ["__x"])
    quartiles = grouped_quantiles(
        points,
        [category],
        "__x",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
        method=LINEAR,
        salts=salts,
        few_groups=few_groups,
        **quantile_options,
    )
    placed = salted_lookup(points, quartiles, [category], [category, "__x"], salts, few_keys=few_groups)
    span = F.lit(reach) * (F.col("q3") - F.col("q1"))
    floor, ceiling = F.col("q1") - span, F.col("q3") + span
    box = ["n", "q1", "median", "q3"]
    return (
        placed.groupBy(category, *box)
        .agg(
            F.min(F.when(F.col("__x") >= floor, F.col("__x"))).alias("lowest"),
            F.max(F.when(F.col("__x") <= ceiling, F.col("__x"))).alias("highest"),
            F.count_if((F.col("__x") < floor) | (F.col("__x") > ceiling)).alias("outliers"),
        )
        .select(
            category,
            *box,
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )
