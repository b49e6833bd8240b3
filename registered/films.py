"""Rankings, searches, summaries, quantiles and chart data over parts and their sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.book import register
from registered.frames import FILMS_SQL, films, table, whole
from sievewell.functions import expressions as X
from sievewell.functions.quantiles import grouped_quantiles
from sievewell.operators import charts as CH
from sievewell.operators import ranking as R
from sievewell.operators import summaries as S
from sievewell.operators.boxstats import box_stats
from sievewell.operators.codebook import CodeBook
from sievewell.operators.sketches import RANK_ERROR, SketchStore, merge_sketches, sketched_quantiles
from sievewell.plans import films as P
from sievewell.plans.scratch import materialized, scratch_path
from sievewell.plans.skew import salted_lookup
from sievewell.sources.writers import report_bundle, section

MIN_BUDGET, MIN_VOTES = 0.7, 30


def rounded(df, digits: int, *columns: str):
    """Rounded where sums of doubles depend on the order of addition.

    Totals are whole 1e-8ths, so 8 digits cannot fall on a half; means get few
    enough digits that a half is next to impossible.
    """
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- rankings ------------------------------------------------------------------------------


def _ranking_sql(spec: R.RankSpec) -> str:
    floor = f"WHERE {spec.floor[0]} >= {spec.floor[1]}" if spec.floor else ""
    direction = "ASC" if spec.ascending else "DESC"
    return f"""
WITH {FILMS_SQL},
placed AS (
  SELECT id, title, {spec.metric}::DOUBLE AS metric,
         row_number() OVER (ORDER BY {spec.metric} {direction} NULLS LAST, id) AS rank, count(*) OVER () AS total
  FROM films {floor}
)
SELECT id, title, metric, rank,
       CASE WHEN rank <= 3 THEN 'Top 3' WHEN total - rank < 3 THEN 'Bottom 3' ELSE 'Top 10' END AS rank_label
FROM placed WHERE rank <= 10"""


def _ranking(spec: R.RankSpec):
    def run(spark, sf_dir):
        ranked = R.rank_by_specs(films(spark, sf_dir), [spec])[spec.name]
        return ranked.select(
            "id", "title", F.col(spec.metric).cast("double").alias("metric"), F.col("rank").cast("bigint").alias("rank"), "rank_label"
        )

    return run


_NUMBERS = dict(zip([s.name for s in R.headline_specs()], range(3, 13)))
for _spec in R.headline_specs(MIN_BUDGET, MIN_VOTES):
    register(
        f"rank_{_spec.name}",
        f"WIN1 WIN2 WIN{_NUMBERS[_spec.name]} PRJ13 PRJ14 PRJ15 PRJ25 SRT1 SRT2 LIM1" + (" FLT4" if _spec.floor else ""),
        _ranking_sql(_spec),
    )(_ranking(_spec))


@register(
    "rank_all",
    "WIN1 WIN2 " + " ".join(f"WIN{n}" for n in _NUMBERS.values()) + " PRJ25 SRT1 LIM1 FLT4",
    " UNION ALL ".join(f"SELECT '{s.name}' AS ranking, * FROM ({_ranking_sql(s)})" for s in R.headline_specs(MIN_BUDGET, MIN_VOTES)),
)
def rank_all(spark, sf_dir):
    """The ten rankings from one read of the films."""
    specs = R.headline_specs(MIN_BUDGET, MIN_VOTES)
    metric = F.coalesce(*[F.when(F.col("ranking") == s.name, F.col(s.metric).cast("double")) for s in specs])
    ranked = R.rank_all(films(spark, sf_dir), specs)
    return ranked.select("ranking", "id", "title", metric.alias("metric"), F.col("rank").cast("bigint").alias("rank"), "rank_label")


@register(
    "rank_labels_short_input",
    "WIN1 PRJ25 AGG13 UDF1 VAL4",
    """
WITH placed AS (
  SELECT r_regionkey::BIGINT AS id, r_name, row_number() OVER (ORDER BY r_name DESC) AS rank, count(*) OVER () AS total FROM region
)
SELECT id, r_name, rank, total, CASE WHEN rank <= 3 THEN 'Top 3' WHEN total - rank < 3 THEN 'Bottom 3' ELSE 'Top 10' END AS rank_label
FROM placed""",
)
def rank_labels_short_input(spark, sf_dir):
    """A whole input shorter than the ranking; the label through the SQL function."""
    R.register_rank_label(spark)
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("id"), "r_name")
    ranked = R.rank_top(regions, "r_name", top_n=10).drop("rank_label")
    return S.with_row_total(ranked).select(
        "id", "r_name", F.col("rank").cast("bigint").alias("rank"), "total", F.expr("rank_label(rank, total)").alias("rank_label")
    )


@register(
    "row_share_of_total",
    "AGG13 PRJ29",
    """
SELECT o_orderkey, total, o_orderkey::DOUBLE / total::DOUBLE AS share FROM orders, (SELECT count(*) AS total FROM orders)""",
)
def row_share_of_total(spark, sf_dir):
    orders = S.with_row_total(table(spark, sf_dir, "orders").select("o_orderkey"))
    return orders.withColumn("share", X.guarded_ratio(F.col("o_orderkey").cast("double"), F.col("total").cast("double")))


# --- searches --------------------------------------------------------------------------------


@register(
    "search_terms",
    "FLT5 SRT1",
    f"""
WITH {FILMS_SQL}
SELECT id, title, genres, director, vote_average FROM films
WHERE contains(genres, 're') AND contains(genres, 'in') AND contains("cast", 'r')""",
)
def search_terms(spark, sf_dir):
    found = P.best_rated_with(films(spark, sf_dir), ["re", "in"], "r")
    return found.select("id", "title", "genres", "director", "vote_average")


@register(
    "search_exact",
    "FLT6 SRT1",
    f"""
WITH {FILMS_SQL}
SELECT id, title, director, runtime FROM films WHERE contains("cast", 'ring') AND director = 'ECONOMY'""",
)
def search_exact(spark, sf_dir):
    return P.directed_by_with(films(spark, sf_dir), "ECONOMY", "ring").select("id", "title", "director", "runtime")


# --- comparisons and summaries -----------------------------------------------------------------


@register(
    "compare_groups",
    "AGG1 AGG2 PRJ24 SRT2",
    f"""
WITH {FILMS_SQL}
SELECT belongs_to_collection IS NOT NULL AS is_franchise,
       round(avg(revenue_musd), 6) AS mean_revenue_musd, quantile_disc(roi, 0.5) AS median_roi,
       round(avg(budget_musd), 6) AS mean_budget_musd, round(avg(popularity), 2) AS mean_popularity,
       round(avg(vote_average), 6) AS mean_rating
FROM films GROUP BY ALL""",
)
def compare_groups(spark, sf_dir):
    compared = rounded(P.compare_franchise(films(spark, sf_dir)), 6, "mean_revenue_musd", "mean_budget_musd", "mean_rating")
    return rounded(compared, 2, "mean_popularity")


@register(
    "compare_groups_sketched",
    "AGG1 AGG2",
    f"""
WITH {FILMS_SQL}
SELECT belongs_to_collection IS NOT NULL AS is_franchise, round(avg(roi), 6) AS mean_roi, quantile_disc(roi, 0.5) AS median_roi
FROM films GROUP BY ALL""",
)
def compare_groups_sketched(spark, sf_dir):
    """The one-pass variant; its median may be off in rank by a share of 1/accuracy."""
    compared = S.compare_by_presence_approx(
        films(spark, sf_dir), "belongs_to_collection", {"mean_roi": "roi"}, ("median_roi", "roi"), "is_franchise", 1_000_000
    )
    return rounded(compared, 6, "mean_roi")


@register(
    "group_summary",
    "AGG3 FLT7 SRT1",
    f"""
WITH {FILMS_SQL}
SELECT belongs_to_collection, count(id) AS movie_count, round(sum(budget_musd), 8) AS total_budget_musd,
       round(avg(budget_musd), 5) AS mean_budget_musd, round(sum(revenue_musd), 8) AS total_revenue_musd,
       round(avg(revenue_musd), 5) AS mean_revenue_musd, round(avg(vote_average), 5) AS mean_rating
FROM films WHERE belongs_to_collection IS NOT NULL GROUP BY ALL""",
)
def group_summary(spark, sf_dir):
    summary = rounded(P.franchise_summary(films(spark, sf_dir)), 8, "total_budget_musd", "total_revenue_musd")
    return rounded(summary, 5, "mean_budget_musd", "mean_revenue_musd", "mean_rating")


@register(
    "entity_summary",
    "AGG4 FLT7 SRT1",
    f"""
WITH {FILMS_SQL}
SELECT director, count(id) AS movie_count, round(sum(revenue_musd), 8) AS total_revenue_musd,
       round(avg(vote_average), 6) AS mean_rating
FROM films WHERE director IS NOT NULL GROUP BY ALL""",
)
def entity_summary(spark, sf_dir):
    return rounded(rounded(P.director_summary(films(spark, sf_dir)), 8, "total_revenue_musd"), 6, "mean_rating")


@register(
    "yearly_orders",
    "AGG5 PRJ23 FLT7 SRT2",
    """
SELECT year(o_orderdate)::INTEGER AS order_year, count(o_orderkey) AS orders, round(avg(o_totalprice), 2) AS mean_total
FROM orders GROUP BY ALL""",
)
def yearly_orders(spark, sf_dir):
    yearly = S.summarize_years(
        table(spark, sf_dir, "orders"), "o_orderdate", count=("orders", "o_orderkey"), means={"mean_total": "o_totalprice"}, year="order_year"
    )
    return rounded(yearly, 2, "mean_total")


# --- quantiles ------------------------------------------------------------------------------------


QUARTERS = (0.25, 0.5, 0.75)


@register(
    "sketched_quartiles",
    "AGG2 AGG12",
    f"""
SELECT year(o_orderdate)::INTEGER AS order_year, probability, count(o_totalprice) AS n, true AS within
FROM orders, (SELECT unnest({list(QUARTERS)})::DOUBLE AS probability) WHERE o_totalprice IS NOT NULL GROUP BY ALL""",
)
def sketched_quartiles(spark, sf_dir):
    """Yearly quartiles merged from stored monthly sketches, each held against its exact rank among the year's orders.

    Sketches are drawn by chance, so that it is the rank's place that is the same each time, not the value.
    """
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.year("o_orderdate").alias("order_year"), "o_totalprice")
    store = SketchStore(scratch_path(spark, "sketches"), ("order_year",))
    for late in (False, True):
        # The second half of each year comes in a run of its own.
        store.add(orders.where((F.substring("period", 6, 2) > "06") == F.lit(late)), "o_totalprice")
    found = materialized(sketched_quantiles(merge_sketches(store.read(spark), ["order_year"]), ["order_year"], QUARTERS), "quartiles")
    by_year = found.groupBy("order_year").agg(F.map_from_entries(F.collect_list(F.struct("probability", "value"))).alias("at"))
    # Three values for each year.
    placed = salted_lookup(orders, by_year, ["order_year"], ["o_totalprice"], few_keys=True)
    ranks = placed.groupBy("order_year").agg(
        *[F.count_if(F.col("o_totalprice") < F.col("at")[F.lit(q)]).alias(f"below{i}") for i, q in enumerate(QUARTERS)],
        *[F.count_if(F.col("o_totalprice") <= F.col("at")[F.lit(q)]).alias(f"upto{i}") for i, q in enumerate(QUARTERS)],
    )
    exact = ranks.select("order_year", F.explode(F.array(*[
        F.struct(F.lit(q).alias("probability"), F.col(f"below{i}").alias("below"), F.col(f"upto{i}").alias("upto")) for i, q in enumerate(QUARTERS)
    ])).alias("rank")).select("order_year", "rank.*")
    wanted, slack = F.col("probability") * F.col("n"), F.col("n") * F.lit(RANK_ERROR) + 1
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return found.join(exact, ["order_year", "probability"]).select("order_year", "probability", "n", within.alias("within"))


@register(
    "exact_medians",
    "AGG2 AGG12",
    """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, quantile_disc(l_extendedprice, 0.5) AS median,
       quantile_disc(l_extendedprice, 0.9) AS p90
FROM lineitem GROUP BY ALL""",
)
def exact_medians(spark, sf_dir):
    """Small sketch and threshold, so that the bracketing path itself is checked."""
    return grouped_quantiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
        {"median": 0.5, "p90": 0.9}, accuracy=1000,
    )


@register(
    "typed_medians",
    "AGG2",
    """
WITH typed AS (
  SELECT l_returnflag, 9007199254740993 + l_orderkey * 64 + l_linenumber AS big,
         cast(round(l_extendedprice * 100)::BIGINT AS DECIMAL(25, 0)) AS cents FROM lineitem
), big AS (SELECT l_returnflag, count(big) AS n, quantile_disc(big, 0.5)::BIGINT AS median FROM typed GROUP BY ALL),
cents AS (SELECT l_returnflag, quantile_disc(cents, 0.5)::VARCHAR AS median_cents FROM typed GROUP BY ALL)
SELECT * FROM big JOIN cents USING (l_returnflag)""",
)
def typed_medians(spark, sf_dir):
    """Integers beyond 2^53 and decimals keep their type and their last digit."""
    typed = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        (F.lit(9007199254740993) + F.col("l_orderkey").cast("bigint") * 64 + F.col("l_linenumber")).alias("big"),
        whole("l_extendedprice", 100).cast("decimal(25,0)").alias("cents"),
    )
    big = grouped_quantiles(typed, ["l_returnflag"], "big", {"median": 0.5}, accuracy=1000)
    cents = grouped_quantiles(typed, ["l_returnflag"], "cents", {"median_cents": 0.5}, accuracy=1000).drop("n")
    return big.join(cents.withColumn("median_cents", F.col("median_cents").cast("string")), "l_returnflag")


@register(
    "global_quartiles",
    "AGG2",
    """
SELECT count(o_totalprice) AS n, round(quantile_cont(o_totalprice, 0.25), 4) AS q1,
       round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS q3
FROM orders""",
)
def global_quartiles(spark, sf_dir):
    quartiles = grouped_quantiles(
        table(spark, sf_dir, "orders"), [], "o_totalprice", {"q1": 0.25, "median": 0.5, "q3": 0.75},
        method="cont", accuracy=1000,
    )
    return rounded(quartiles, 4, "q1", "median", "q3")


def _box_sql(source: str, category: str, value: str) -> str:
    return f"""
WITH {source}
quartiles AS (
  SELECT {category} AS category, count({value}) AS n, quantile_cont({value}, 0.25) AS q1,
         quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM points WHERE {value} IS NOT NULL GROUP BY ALL
)
SELECT category, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(least(min({value}) FILTER ({value} >= q1 - 1.5e0 * (q3 - q1)), q1), 6) AS whisker_low,
       round(greatest(max({value}) FILTER ({value} <= q3 + 1.5e0 * (q3 - q1)), q3), 6) AS whisker_high,
       count(*) FILTER ({value} < q1 - 1.5e0 * (q3 - q1) OR {value} > q3 + 1.5e0 * (q3 - q1)) AS outliers
FROM points JOIN quartiles ON {category} = category WHERE {value} IS NOT NULL
GROUP BY category, n, q1, median, q3"""


_BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@register("box_stats_events", "AGG12", _box_sql("points AS (SELECT event_type, value FROM events),", "event_type", "value"))
def box_stats_events(spark, sf_dir):
    boxes = box_stats(table(spark, sf_dir, "events"), "event_type", "value", accuracy=1000)
    return rounded(boxes.withColumnRenamed("event_type", "category"), 6, *_BOX)


# --- chart data -------------------------------------------------------------------------------------


@register(
    "primary_token",
    "PRJ26 PRJ28",
    f"""
WITH {FILMS_SQL}
SELECT id, coalesce(split_part(belongs_to_collection, '#', 1), 'Unknown') AS token,
       CASE WHEN belongs_to_collection IS NOT NULL THEN 'Franchise' ELSE 'Standalone' END AS label
FROM films""",
)
def primary_token(spark, sf_dir):
    group = F.col("belongs_to_collection")
    return films(spark, sf_dir).select(
        "id", X.first_token(group, "#").alias("token"), X.flag_label(X.present(group), "Franchise", "Standalone").alias("label")
    )


_CODES_SQL = """
codes AS (
  SELECT label, row_number() OVER (ORDER BY md5(label)[1:3], label) - 1 AS code FROM (SELECT DISTINCT label FROM points)
)"""


@register(
    "category_codes",
    "PRJ27",
    f"""
WITH points AS (SELECT DISTINCT title AS label FROM (SELECT p_name AS title FROM part)), {_CODES_SQL}
SELECT label, code FROM codes""",
)
def category_codes(spark, sf_dir):
    return CH.category_codes(table(spark, sf_dir, "part").withColumnRenamed("p_name", "label"), "label")


@register(
    "category_codes_kept",
    "PRJ27",
    """
WITH labels AS (SELECT p_name AS label, bool_or(p_partkey % 2 = 0) AS early FROM part WHERE p_name IS NOT NULL GROUP BY ALL)
SELECT label, row_number() OVER (ORDER BY NOT early, md5(label)[1:3], label) - 1 AS code FROM labels""",
)
def category_codes_kept(spark, sf_dir):
    """Half of the parts get codes first; the run over all parts keeps them and numbers the other labels on."""
    parts, book = table(spark, sf_dir, "part").withColumnRenamed("p_name", "label"), CodeBook(scratch_path(spark, "codes"))
    book.add(parts.where("p_partkey % 2 = 0"))
    return book.add(parts)


def _points_sql(x: str, y: str) -> str:
    return f"""
WITH {FILMS_SQL},
points AS (
  SELECT id, {x}, {y}, split_part(production_companies, '|', 1) AS label FROM films
  WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL AND roi IS NOT NULL
), {_CODES_SQL}
SELECT id, {x}, {y}, label, code FROM points JOIN codes USING (label)"""


_COMPLETE = ("budget_musd", "revenue_musd", "roi")


@register("chart_revenue_budget", "CHT1 FLT8 PRJ26 PRJ27", _points_sql("budget_musd", "revenue_musd"))
def chart_revenue_budget(spark, sf_dir):
    return CH.coded_points(films(spark, sf_dir), "budget_musd", "revenue_musd", "production_companies", _COMPLETE, ["id"])


@register("chart_popularity_rating", "CHT3 FLT8 PRJ26 PRJ27", _points_sql("popularity", "vote_average"))
def chart_popularity_rating(spark, sf_dir):
    return CH.coded_points(films(spark, sf_dir), "popularity", "vote_average", "production_companies", _COMPLETE, ["id"])


@register(
    "chart_roi_by_token",
    "CHT2 AGG12 FLT8 PRJ26",
    _box_sql(f"{FILMS_SQL}, points AS (SELECT split_part(genres, '|', 1) AS g, roi FROM films),", "g", "roi"),
)
def chart_roi_by_token(spark, sf_dir):
    return rounded(CH.value_by_token(films(spark, sf_dir), "roi", "genres", _COMPLETE, "category"), 6, *_BOX)


@register(
    "chart_yearly",
    "CHT4 AGG5",
    f"""
WITH {FILMS_SQL},
yearly AS (
  SELECT year(release_date)::INTEGER AS release_year, avg(budget_musd) AS mean_budget_musd, avg(revenue_musd) AS mean_revenue_musd
  FROM films GROUP BY ALL
)
SELECT release_year, 'mean_budget_musd' AS metric, round(mean_budget_musd, 6) AS value FROM yearly
UNION ALL SELECT release_year, 'mean_revenue_musd', round(mean_revenue_musd, 6) FROM yearly""",
)
def chart_yearly(spark, sf_dir):
    yearly = P.yearly_trends(films(spark, sf_dir))
    return rounded(CH.long_series(yearly, ["release_year"], ["mean_budget_musd", "mean_revenue_musd"]), 6, "value")


@register(
    "chart_group_bars",
    "CHT5 AGG1 PRJ28",
    f"""
WITH {FILMS_SQL},
bars AS (
  SELECT CASE WHEN belongs_to_collection IS NOT NULL THEN 'Franchise' ELSE 'Standalone' END AS label,
         avg(revenue_musd) AS mean_revenue_musd, avg(budget_musd) AS mean_budget_musd,
         avg(popularity) AS mean_popularity, avg(vote_average) AS mean_rating
  FROM films GROUP BY ALL
)
SELECT label, metric, round(value, 2) AS value
FROM bars UNPIVOT (value FOR metric IN (mean_revenue_musd, mean_budget_musd, mean_popularity, mean_rating))""",
)
def chart_group_bars(spark, sf_dir):
    comparison = P.compare_franchise(films(spark, sf_dir))
    bars = CH.labelled_bars(
        comparison, "is_franchise", ["mean_revenue_musd", "mean_budget_musd", "mean_popularity", "mean_rating"], "Franchise", "Standalone"
    )
    return rounded(bars, 2, "value")


@register(
    "report_sections",
    "SNK10 LIM2",
    f"""
WITH {FILMS_SQL},
top AS (SELECT id, title, row_number() OVER (ORDER BY revenue_musd DESC, id) AS position FROM films),
makers AS (
  SELECT director, movie_count, row_number() OVER (ORDER BY total DESC, director) AS position
  FROM (SELECT director, count(id) AS movie_count, sum(revenue_musd) AS total FROM films GROUP BY director)
),
years AS (SELECT year(release_date) AS release_year, count(id) AS movie_count FROM films GROUP BY 1)
SELECT 'Highest Revenue' AS section, position, '{{"id":' || id || ',"title":"' || title || '"}}' AS row_json FROM top WHERE position <= 5
UNION ALL
SELECT 'Directors', position, '{{"director":"' || director || '","movie_count":' || movie_count || '}}' FROM makers WHERE position <= 10
UNION ALL
SELECT 'Years', row_number() OVER (ORDER BY release_year), '{{"release_year":' || release_year || ',"movie_count":' || movie_count || '}}' FROM years""",
)
def report_sections(spark, sf_dir):
    base = films(spark, sf_dir)
    ranking = R.rank_top(base, "revenue_musd")
    makers = P.director_summary(base)
    years = P.yearly_trends(base)
    # Rows are numbered in the order of each result, then cut to two columns.
    return report_bundle(
        [
            _slim(section("Highest Revenue", ranking.select("id", "title", "rank"), [F.col("rank")], 5), "id", "title"),
            _slim(
                section("Directors", makers, [R.by("total_revenue_musd"), F.col("director")]), "director", "movie_count"
            ),
            _slim(section("Years", years, [F.col("release_year")], None), "release_year", "movie_count"),
        ]
    )


def _slim(part, text_or_key: str, other: str):
    """Keep two JSON fields (the others hold unrounded means)."""
    kinds = {"id": "bigint", "release_year": "int", "movie_count": "bigint"}
    fields = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in (text_or_key, other))
    return part.withColumn("row_json", F.to_json(F.from_json("row_json", fields)))
