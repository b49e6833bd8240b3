"""Group comparisons, entity and yearly summaries, tallies: AGG1-AGG7, AGG11, AGG13, FLT7, PRJ23, PRJ24."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewell.functions.quantiles import grouped_quantiles
from sievewell.operators.ranking import by


def compare_by_presence(
    df: DataFrame,
    column: str,
    means: Mapping[str, str],
    median: tuple[str, str] | None = None,
    flag: str = "is_present",
    **quantile_options: int,
) -> DataFrame:
    """AGG1: rows with and without ``column``: means and one exact lower median.

    ``means`` maps output name to column, ``median`` is (output name, column).
    The means ride on the first of the two passes the median takes.
    """
    flagged = df.withColumn(flag, F.col(column).isNotNull())
    averages = {name: F.avg(c) for name, c in means.items()}
    if median is None:
        compared = flagged.groupBy(flag).agg(*[c.alias(name) for name, c in averages.items()])
    else:
        name, value = median
        compared = grouped_quantiles(
            flagged, [flag], value, {name: 0.5}, carry=averages, few_groups=True, **quantile_options
        ).drop("n")
    return compared.orderBy(F.col(flag).desc())


def compare_by_presence_approx(
    df: DataFrame,
    column: str,
    means: Mapping[str, str],
    median: tuple[str, str],
    flag: str = "is_present",
    accuracy: int = 10_000,
) -> DataFrame:
    """AGG1 with the sketched median of AGG2: one pass, off by at most 1/accuracy in rank."""
    name, value = median
    return (
        df.withColumn(flag, F.col(column).isNotNull())
        .groupBy(flag)
        .agg(
            *[F.avg(c).alias(out) for out, c in means.items()],
            F.percentile_approx(value, 0.5, accuracy).alias(name),
        )
        .orderBy(F.col(flag).desc())
    )


def summarize_entity(
    df: DataFrame,
    key: str,
    *,
    count: tuple[str, str],
    sums: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    rank_by: str | None = None,
) -> DataFrame:
    """AGG3/AGG4: per entity count, sums and means, best first; NULL entities left out.

    ``count`` is (output name, counted column); ``sums`` and ``means`` map
    output name to column; equal totals are ordered by entity.
    """
    outputs = [F.count(count[1]).alias(count[0])]
    outputs += [F.sum(c).alias(name) for name, c in (sums or {}).items()]
    outputs += [F.avg(c).alias(name) for name, c in (means or {}).items()]
    summary = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*outputs)
    return summary.orderBy(by(rank_by), F.col(key).asc()) if rank_by else summary


def summarize_years(
    df: DataFrame, day: str, *, count: tuple[str, str], means: Mapping[str, str], year: str = "release_year"
) -> DataFrame:
    """AGG5: per calendar year count and means, oldest first; rows without a date left out."""
    return (
        df.filter(F.col(day).isNotNull())
        .groupBy(F.year(day).alias(year))
        .agg(F.count(count[1]).alias(count[0]), *[F.avg(c).alias(name) for name, c in means.items()])
        .orderBy(year)
    )


def tally(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """AGG11: rows per value of one column, ordered by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(column)


def reason_tally(df: DataFrame, reason: str = "validation_reason", name: str = "n") -> DataFrame:
    """AGG6: rejected rows per reason.

    Valid rows are left out by their count of reasons rather than by a filter:
    a filter would be pushed below the validation and run every rule twice.
    """
    return df.groupBy(reason).agg(F.count(reason).alias(name)).filter(F.col(name) > 0).orderBy(reason)


def outcome_counts(df: DataFrame, valid: str = "is_valid") -> DataFrame:
    """AGG7: one row of received, valid and rejected counts."""
    return df.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col(valid)).alias("valid"),
        F.count_if(~F.col(valid)).alias("rejected"),
    )


def with_row_total(df: DataFrame, name: str = "total") -> DataFrame:
    """AGG13: every row beside the size of the whole input.

    A scalar subquery, computed once in the same job; not an action, not a join.
    """
    return df.withColumn(name, df.agg(F.count(F.lit(1))).scalar())


def usable_number(column: str, spark_type: str) -> Column:
    """Neither NULL nor NaN, in a form whose NULL test reaches the scan."""
    known = F.col(column).isNotNull()
    return known & ~F.isnan(column) if spark_type in ("double", "float") else known


def keep_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FLT8: rows with a usable value in every column (``dropna``, but pushed down)."""
    kinds = dict(df.dtypes)
    return df.filter(reduce(lambda a, b: a & b, [usable_number(c, kinds[c]) for c in columns]))
