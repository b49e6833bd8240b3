"""Top-N rankings with plain-language labels: WIN1-WIN12, PRJ25, FLT4, SRT1, LIM1, UDF1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Label texts and the number of rows at either end they cover.
TOP_LABEL, BOTTOM_LABEL, MIDDLE_LABEL = "Top 3", "Bottom 3", "Top 10"
END_ROWS = 3


def rank_label(rank: Column, total: Column) -> Column:
    """PRJ25: label of a 1-based rank among ``total`` rows; the top wins over the bottom."""
    return (
        F.when(rank <= END_ROWS, F.lit(TOP_LABEL))
        .when(total - rank < END_ROWS, F.lit(BOTTOM_LABEL))
        .otherwise(F.lit(MIDDLE_LABEL))
    )


def register_rank_label(spark: SparkSession, name: str = "rank_label") -> None:
    """UDF1: the label as a SQL function ``name(rank, total)``, inlined by Catalyst."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(r BIGINT, total BIGINT) RETURNS STRING RETURN "
        f"CASE WHEN r <= {END_ROWS} THEN '{TOP_LABEL}' "
        f"WHEN total - r < {END_ROWS} THEN '{BOTTOM_LABEL}' ELSE '{MIDDLE_LABEL}' END"
    )


def by(column: str, ascending: bool = False) -> Column:
    """SRT1: sort key with NULLs last in either direction (SRT2, plain sorts, need no helper)."""
    return F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """VAL4: fail while the plan is built when a column is missing."""
    for name in columns:
        if name not in df.columns:
            raise KeyError(f"no column {name!r} to rank by; there are {df.columns}")


def rank_top(
    df: DataFrame,
    metric: str,
    *,
    ascending: bool = False,
    top_n: int = 10,
    tie_break: Sequence[str] = ("id",),
) -> DataFrame:
    """WIN1: the first ``top_n`` rows by ``metric`` with ``rank`` and ``rank_label``.

    The label depends on the size of the whole input only where fewer than
    three rows follow, so reading three rows past ``top_n`` settles it: one
    bounded top-k pass, no count of the input.
    """
    check_columns(df, [metric, *tie_break])
    order = [by(metric, ascending), *[F.col(c).asc_nulls_last() for c in tie_break]]
    head = df.orderBy(*order).limit(top_n + END_ROWS)
    seen = F.count(F.lit(1)).over(W.partitionBy())
    return (
        head.withColumns({"rank": F.row_number().over(W.orderBy(*order)), "__seen": seen})
        .withColumn("rank_label", rank_label(F.col("rank"), F.col("__seen")))
        .filter(F.col("rank") <= top_n)
        .drop("__seen")
        .orderBy("rank")
    )


@dataclass(frozen=True)
class RankSpec:
    """One named ranking; ``floor`` = (column, least value) limits who takes part."""

    name: str
    metric: str
    ascending: bool = False
    floor: tuple[str, float] | None = None


def headline_specs(min_budget: float = 10, min_votes: float = 10) -> list[RankSpec]:
    """WIN3-WIN12: the ten named rankings."""
    funded, voted = ("budget_musd", min_budget), ("vote_count", min_votes)
    return [
        RankSpec("highest_revenue", "revenue_musd"),
        RankSpec("highest_budget", "budget_musd"),
        RankSpec("highest_profit", "profit_musd"),
        RankSpec("lowest_profit", "profit_musd", ascending=True),
        RankSpec("highest_roi", "roi", floor=funded),
        RankSpec("lowest_roi", "roi", ascending=True, floor=funded),
        RankSpec("most_voted", "vote_count"),
        RankSpec("highest_rated", "vote_average", floor=voted),
        RankSpec("lowest_rated", "vote_average", ascending=True, floor=voted),
        RankSpec("most_popular", "popularity"),
    ]


def eligible(df: DataFrame, floor: tuple[str, float] | None) -> DataFrame:
    """FLT4: rows reaching a least value (NULL does not)."""
    return df if floor is None else df.filter(F.col(floor[0]) >= F.lit(floor[1]))


def rank_by_specs(
    df: DataFrame, specs: Sequence[RankSpec], *, top_n: int = 10, tie_break: Sequence[str] = ("id",)
) -> Mapping[str, DataFrame]:
    """Every spec's ranking, by name."""
    return {
        s.name: rank_top(eligible(df, s.floor), s.metric, ascending=s.ascending, top_n=top_n, tie_break=tie_break)
        for s in specs
    }


def build_rankings(
    df: DataFrame,
    *,
    top_n: int = 10,
    min_budget: float = 10,
    min_votes: float = 10,
    tie_break: Sequence[str] = ("id",),
) -> Mapping[str, DataFrame]:
    """The ten headline rankings of a clean table."""
    return rank_by_specs(df, headline_specs(min_budget, min_votes), top_n=top_n, tie_break=tie_break)


def rank_all(
    df: DataFrame, specs: Sequence[RankSpec], *, top_n: int = 10, tie_break: Sequence[str] = ("id",)
) -> DataFrame:
    """WIN1-WIN12: every spec's ranking as one frame, from one read of ``df``.

    Rows are those of ``rank_top`` for each spec, behind a column ``ranking``
    with its name; a column of ``df`` called ``ranking``, ``rank`` or
    ``rank_label`` is left out.  A row takes part once for each ranking that
    it qualifies for; each task keeps the first ``top_n`` and three more of
    each ranking, and only those are shuffled.  Metrics are compared as
    doubles.
    """
    check_columns(df, [*[s.metric for s in specs], *tie_break])
    entries = []
    for number, s in enumerate(specs):
        value = F.col(s.metric).cast("double")
        # NULLs come last; NaN counts as the largest value.
        lead = F.when(value.isNull(), 2).when(F.isnan(value), 1 if s.ascending else -1).otherwise(0)
        entry = F.struct(
            F.lit(number).alias("number"), lead.alias("lead"), F.nanvl(value if s.ascending else -value, F.lit(0.0)).alias("value")
        )
        entries.append(entry if s.floor is None else F.when(F.col(s.floor[0]) >= F.lit(s.floor[1]), entry))
    kept = [c for c in df.columns if c not in ("ranking", "rank", "rank_label")]
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.array_compact(F.array(*entries)).alias("entries"))
    each = row.select("row", F.explode("entries").alias("entry"))
    order = ["entry.lead", "entry.value", *[F.col(f"row.`{c}`").asc_nulls_last() for c in tie_break]]
    head = each.withColumn("rank", F.row_number().over(W.partitionBy("entry.number").orderBy(*order))).filter(F.col("rank") <= top_n + END_ROWS)
    seen = F.count(F.lit(1)).over(W.partitionBy("entry.number"))
    names = F.array(*[F.lit(s.name) for s in specs])
    return (
        head.withColumn("rank_label", rank_label(F.col("rank"), seen))
        .filter(F.col("rank") <= top_n)
        .select(F.get(names, F.col("entry.number")).alias("ranking"), "row.*", "rank", "rank_label")
    )
