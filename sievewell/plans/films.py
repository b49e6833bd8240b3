"""Film catalogue preset: raw nested records to clean table, rankings, summaries, charts, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewell import schemas
from sievewell.operators import cleaning as C
from sievewell.operators.charts import movie_charts
from sievewell.operators.ranking import build_rankings, by
from sievewell.operators.search import search
from sievewell.operators.summaries import compare_by_presence, summarize_entity, summarize_years
from sievewell.sources.writers import RANKING_ROWS, report_bundle, section

# Columns of the raw records and how each is treated.
DROPPED = ("adult", "imdb_id", "original_title", "video", "homepage")
STRUCTS = ("belongs_to_collection",)
ARRAYS = ("genres", "production_countries", "production_companies", "spoken_languages")
NUMBERS = {
    "id": "bigint", "budget": "double", "revenue": "double", "runtime": "double",
    "popularity": "double", "vote_count": "bigint", "vote_average": "double",
}
DAYS = ("release_date",)
ZERO_IS_UNKNOWN = ("budget", "revenue", "runtime")
PLACEHOLDER_COLUMNS = ("overview", "tagline")
PLACEHOLDERS = ("No Data", "")
RELEASED = "Released"
MIN_POPULATED = 10

# What the two preset searches look for.
SEARCH_GENRES, SEARCH_ACTOR = ("Science Fiction", "Action"), "Bruce Willis"
SEARCH_DIRECTOR, SEARCH_LEAD = "Quentin Tarantino", "Uma Thurman"


def shape_records(raw: DataFrame) -> DataFrame:
    """Row-local part of the cleaning: flatten, type, null out, derive."""
    return C.chain(
        raw,
        lambda df: C.drop_columns(df, DROPPED),
        lambda df: C.flatten_structs(df, STRUCTS),
        lambda df: C.flatten_arrays(df, ARRAYS),
        C.extract_people,
        lambda df: C.coerce_types(df, NUMBERS, DAYS),
        lambda df: C.null_sentinels(df, ZERO_IS_UNKNOWN, PLACEHOLDER_COLUMNS, PLACEHOLDERS),
        C.money_metrics,
    )


def clean_records(
    raw: DataFrame, *, prefer: Sequence[str] | None = None, min_populated: int = MIN_POPULATED, status: str = RELEASED
) -> DataFrame:
    """Raw nested records to the 24-column clean table.

    Rows without an id fall anyway and go before the shuffle, so a large share
    of them costs nothing.
    """
    return C.chain(
        shape_records(raw),
        lambda df: C.require(df, ["id"]),
        lambda df: C.one_per_key(df, "id", prefer),
        lambda df: C.require(df, ["title"]),
        lambda df: C.drop_sparse(df, min_populated),
        lambda df: C.keep_status(df, status),
        lambda df: C.conform(df, schemas.CLEAN_SCHEMA),
    )


def funnel(raw: DataFrame, *, prefer: Sequence[str] = (), min_populated: int = MIN_POPULATED, status: str = RELEASED) -> DataFrame:
    """VAL5 for this preset."""
    return C.cleaning_funnel(shape_records(raw), prefer=prefer, minimum=min_populated, wanted=status)


def best_rated_with(df: DataFrame, genres: Sequence[str], actor: str) -> DataFrame:
    """FLT5: films of all given genres with an actor, best rated first."""
    return search(df, {"genres": genres, "cast": [actor]}, order=[by("vote_average"), F.col("id")])


def directed_by_with(df: DataFrame, director: str, actor: str) -> DataFrame:
    """FLT6: a director's films with an actor, shortest first."""
    return search(df, {"cast": [actor]}, {"director": director}, [by("runtime", ascending=True), F.col("id")])


def compare_franchise(df: DataFrame, **quantile_options: int) -> DataFrame:
    """AGG1: films in a collection against others."""
    return compare_by_presence(
        df,
        "belongs_to_collection",
        {
            "mean_revenue_musd": "revenue_musd",
            "mean_budget_musd": "budget_musd",
            "mean_popularity": "popularity",
            "mean_rating": "vote_average",
        },
        ("median_roi", "roi"),
        "is_franchise",
        **quantile_options,
    ).select("is_franchise", "mean_revenue_musd", "median_roi", "mean_budget_musd", "mean_popularity", "mean_rating")


def franchise_summary(df: DataFrame) -> DataFrame:
    """AGG3: collections by total revenue."""
    return summarize_entity(
        df,
        "belongs_to_collection",
        count=("movie_count", "id"),
        sums={"total_budget_musd": "budget_musd", "total_revenue_musd": "revenue_musd"},
        means={
            "mean_budget_musd": "budget_musd",
            "mean_revenue_musd": "revenue_musd",
            "mean_rating": "vote_average",
        },
        rank_by="total_revenue_musd",
    ).select(
        "belongs_to_collection", "movie_count", "total_budget_musd", "mean_budget_musd",
        "total_revenue_musd", "mean_revenue_musd", "mean_rating",
    )


def director_summary(df: DataFrame) -> DataFrame:
    """AGG4: directors by total revenue."""
    return summarize_entity(
        df,
        "director",
        count=("movie_count", "id"),
        sums={"total_revenue_musd": "revenue_musd"},
        means={"mean_rating": "vote_average"},
        rank_by="total_revenue_musd",
    )


def yearly_trends(df: DataFrame) -> DataFrame:
    """AGG5: release years."""
    return summarize_years(
        df,
        "release_date",
        count=("movie_count", "id"),
        means={"mean_budget_musd": "budget_musd", "mean_revenue_musd": "revenue_musd"},
    )


def run_batch(
    raw: DataFrame,
    *,
    genres: Sequence[str] = SEARCH_GENRES,
    actor: str = SEARCH_ACTOR,
    director: str = SEARCH_DIRECTOR,
    lead: str = SEARCH_LEAD,
    clean: DataFrame | None = None,
) -> Mapping[str, DataFrame]:
    """Every batch result by name, lazily; ``clean`` reuses a cached clean table.

    Wrap ``clean_records(raw)`` in ``plans.scratch.cached`` and pass it in when
    several results are to be computed.
    """
    table = clean if clean is not None else clean_records(raw)
    rankings = build_rankings(table)
    comparison, yearly = compare_franchise(table), yearly_trends(table)
    results = {
        "clean": table,
        **rankings,
        "search_best_rated": best_rated_with(table, genres, actor),
        "search_directed_by": directed_by_with(table, director, lead),
        "franchise_vs_standalone": comparison,
        "franchise_summary": franchise_summary(table),
        "director_summary": director_summary(table),
        "yearly_trends": yearly,
    }
    results |= {f"chart_{name}": df for name, df in movie_charts(table, comparison, yearly).items()}
    results["report"] = report_bundle(
        [section(name, df, [F.col("rank")], RANKING_ROWS) for name, df in rankings.items()]
        + [
            section("search_best_rated", results["search_best_rated"], [by("vote_average"), F.col("id")]),
            section("search_directed_by", results["search_directed_by"], [by("runtime", True), F.col("id")]),
            section("franchise_vs_standalone", comparison, [F.col("is_franchise").desc()]),
            section("franchise_summary", results["franchise_summary"], [by("total_revenue_musd"), F.col("belongs_to_collection")]),
            section("director_summary", results["director_summary"], [by("total_revenue_musd"), F.col("director")]),
            section("yearly_trends", yearly, [F.col("release_year")], None),
        ]
    )
    return results
