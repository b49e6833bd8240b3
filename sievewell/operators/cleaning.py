"""Cleaning steps for nested records: PRJ1-PRJ16, FLT1-FLT3, DED1, VAL5."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewell.functions import expressions as X


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """PRJ30: apply steps left to right."""
    return reduce(lambda frame, step: frame.transform(step), steps, df)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRJ1: drop columns, ignoring absent ones."""
    return df.drop(*columns)


def flatten_structs(df: DataFrame, columns: Sequence[str], field: str = "name") -> DataFrame:
    """PRJ2: replace each present struct column by one of its fields."""
    found = [c for c in columns if c in df.columns]
    return df.withColumns({c: X.struct_field(c, field) for c in found}) if found else df


def flatten_arrays(
    df: DataFrame, columns: Sequence[str], field: str = "name", separator: str = X.LIST_SEPARATOR
) -> DataFrame:
    """PRJ3: replace each present array-of-struct column by its joined field."""
    found = [c for c in columns if c in df.columns]
    return df.withColumns({c: X.joined_field(c, field, separator) for c in found}) if found else df


def extract_people(
    df: DataFrame,
    parent: str = "credits",
    members: str = "cast",
    staff: str = "crew",
    lead_role: str = "Director",
    lead_name: str = "director",
) -> DataFrame:
    """PRJ4-PRJ8: member names and count, staff count and first lead from a nested
    struct, which is then dropped.  Without the struct the frame is unchanged.
    """
    if parent not in df.columns:
        return df
    people, crew = f"{parent}.{members}", f"{parent}.{staff}"
    known = F.col(parent).isNotNull()
    return df.withColumns(
        {
            members: F.when(known, F.coalesce(X.joined_field(people), F.lit(""))),
            f"{members}_size": X.size_under(parent, people),
            lead_name: X.first_match(crew, lambda person: person["job"] == F.lit(lead_role)),
            f"{staff}_size": X.size_under(parent, crew),
        }
    ).drop(parent)


def coerce_types(df: DataFrame, numbers: Mapping[str, str], days: Sequence[str] = ()) -> DataFrame:
    """PRJ9/PRJ10: convert present columns, NULL where a value does not parse."""
    changes = {c: X.to_number(F.col(c), kind) for c, kind in numbers.items() if c in df.columns}
    changes |= {c: X.to_day(F.col(c)) for c in days if c in df.columns}
    return df.withColumns(changes) if changes else df


def null_sentinels(
    df: DataFrame, zero_columns: Sequence[str] = (), text_columns: Sequence[str] = (), placeholders: Sequence[str] = ()
) -> DataFrame:
    """PRJ11/PRJ12: zeros and placeholder texts become NULL."""
    changes = {c: X.zero_to_null(F.col(c)) for c in zero_columns if c in df.columns}
    changes |= {c: X.placeholder_to_null(F.col(c), placeholders) for c in text_columns if c in df.columns}
    return df.withColumns(changes) if changes else df


def money_metrics(
    df: DataFrame,
    cost: str = "budget",
    income: str = "revenue",
    unit: float = 1e6,
    names: tuple[str, str, str, str] = ("budget_musd", "revenue_musd", "profit_musd", "roi"),
) -> DataFrame:
    """PRJ13-PRJ15: scaled cost and income, their difference and ratio."""
    cost_name, income_name, profit_name, ratio_name = names
    spent, earned = X.scaled(F.col(cost), unit), X.scaled(F.col(income), unit)
    return df.withColumns(
        {
            cost_name: spent,
            income_name: earned,
            profit_name: earned - spent,
            ratio_name: X.guarded_ratio(earned, spent),
        }
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ16: exactly the columns of ``schema``, in order; absent ones are typed NULLs."""
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def keep_status(df: DataFrame, wanted: str, column: str = "status") -> DataFrame:
    """FLT1: keep one status and drop the column; unchanged when it is absent."""
    if column not in df.columns:
        return df
    return df.filter(F.col(column) == F.lit(wanted)).drop(column)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FLT2: drop rows with a NULL in any required column."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def populated_count(columns: Sequence[str]) -> Column:
    """Number of non-NULL values among ``columns`` (NaN counts as a value)."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNotNull().cast("int") for c in columns])


def drop_sparse(df: DataFrame, minimum: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """FLT3: keep rows with at least ``minimum`` populated columns (default: all columns)."""
    return df.filter(populated_count(columns or df.columns) >= F.lit(minimum))


def one_per_key(df: DataFrame, key: str | Sequence[str], prefer: Sequence[Column | str] | None = None) -> DataFrame:
    """DED1: one row per key; NULL keys count as one key.

    The survivor is the first in ``prefer`` order, ties going by all other
    columns in turn (but maps, which have no order), so reruns agree.  Spark limits each key to one row before the shuffle, so a
    key repeated in a third of all rows sends one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [*(prefer or ()), *_remaining(df, [*keys, *(prefer or ())])]
    if all(isinstance(c, str) for c in order):
        # One SQL text instead of one driver call per column.
        place = F.expr(f"row_number() OVER (PARTITION BY {_names(keys)} ORDER BY {_names(order)})")
    else:
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def _remaining(df: DataFrame, used: Sequence[Column | str]) -> list[str]:
    """Columns that can settle a tie left by ``used``."""
    taken = {c for c in used if isinstance(c, str)}
    return [f.name for f in df.schema.fields if f.name not in taken and "map<" not in f.dataType.simpleString()]


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


# Stage names of the cleaning funnel, in order.
FUNNEL_STAGES = ("duplicate_or_unknown", "sparse", "unwanted_status", "kept")


def cleaning_funnel(
    df: DataFrame,
    *,
    key: str = "id",
    required: Sequence[str] = ("id", "title"),
    prefer: Sequence[str] = (),
    minimum: int = 10,
    columns: Sequence[str] | None = None,
    status: str = "status",
    wanted: str = "Released",
) -> DataFrame:
    """VAL5: rows lost at each cleaning stage, ``(drop_stage, n)``, in one pass.

    ``df`` is the frame as it stands before deduplication; all four stages are
    listed even when they lost nothing.
    """
    verdict = (
        F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]), F.lit(0))
        .when(populated_count(columns or df.columns) < F.lit(minimum), F.lit(1))
        .when(~F.coalesce(F.col(status) == F.lit(wanted), F.lit(False)), F.lit(2))
        .otherwise(F.lit(3))
    )
    order = [F.col(f"`{c}`") for c in [*prefer, *_remaining(df, [key, *prefer])]]
    # Every key keeps its preferred row; its other copies fall at stage 0.
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"),
        F.min_by(verdict, F.struct(*order)).alias("verdict"),
    )
    tallies = per_key.agg(
        *[
            F.coalesce(
                F.sum(
                    F.when(F.col("verdict") == i, F.lit(1)).otherwise(F.lit(0))
                    + (F.col("copies") - 1 if i == 0 else F.lit(0))
                ),
                F.lit(0),
            )
            .cast("bigint")
            .alias(stage)
            for i, stage in enumerate(FUNNEL_STAGES)
        ]
    )
    return tallies.unpivot([], list(FUNNEL_STAGES), "drop_stage", "n")
