"""Base frames over the test tables, and the same frames as SQL common table expressions.

Money and rates are summed as whole cents and hundredths, so both engines get
the same totals whatever the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewell.functions import expressions as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str, factor: int = 1):
    """A non-negative decimal amount in whole units of 1/factor.

    ``floor(x + 0.5)`` stays in primitive arithmetic; ``round`` on a double
    goes through a decimal object per row.
    """
    return F.floor(F.col(column) * F.lit(float(factor)) + F.lit(0.5))


# --- films: parts with their sales, in the shape of the clean table -------------------


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items summed per part before the join, so only totals meet the parts."""
    sales = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum(whole("l_quantity")).alias("quantity"),
            F.sum(whole("l_extendedprice", 100)).alias("income"),
            F.sum(whole("l_discount", 100)).alias("discounts"),
            F.sum(whole("l_tax", 100)).alias("taxes"),
            F.count(F.lit(1)).alias("vote_count"),
            F.min("l_shipdate").cast("date").alias("release_date"),
        )
    )
    parts = table(spark, sf_dir, "part")
    joined = sales.join(parts, sales["l_partkey"] == parts["p_partkey"])
    budget = (F.col("quantity") * whole("p_retailprice", 100)).cast("double") / F.lit(1e8)
    revenue = F.col("income").cast("double") / F.lit(1e8)
    names = F.translate("p_name", " ", X.LIST_SEPARATOR)
    return joined.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        names.alias("genres"),
        names.alias("cast"),
        F.col("p_type").alias("director"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("belongs_to_collection"),
        F.concat_ws(X.LIST_SEPARATOR, "p_brand", "p_type").alias("production_companies"),
        budget.alias("budget_musd"),
        revenue.alias("revenue_musd"),
        (revenue - budget).alias("profit_musd"),
        X.guarded_ratio(revenue, budget).alias("roi"),
        "vote_count",
        (F.col("discounts").cast("double") / F.col("vote_count").cast("double")).alias("vote_average"),
        (F.col("taxes").cast("double") / F.lit(10.0)).alias("popularity"),
        F.col("p_size").cast("double").alias("runtime"),
        "release_date",
    )


FILMS_SQL = """
sales AS (
  SELECT l_partkey,
         sum(round(l_quantity)::BIGINT)::BIGINT AS quantity,
         sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS income,
         sum(round(l_discount * 100)::BIGINT)::BIGINT AS discounts,
         sum(round(l_tax * 100)::BIGINT)::BIGINT AS taxes,
         count(*) AS vote_count,
         min(l_shipdate)::DATE AS release_date
  FROM lineitem GROUP BY l_partkey
),
money AS (
  SELECT *, (quantity * round(p_retailprice * 100)::BIGINT)::DOUBLE / 1e8 AS budget_musd,
         income::DOUBLE / 1e8 AS revenue_musd
  FROM sales JOIN part ON l_partkey = p_partkey
),
films AS (
  SELECT p_partkey AS id, p_name AS title, replace(p_name, ' ', '|') AS genres,
         replace(p_name, ' ', '|') AS "cast", p_type AS director,
         nullif(p_brand, 'Brand#1') AS belongs_to_collection,
         p_brand || '|' || p_type AS production_companies,
         budget_musd, revenue_musd, revenue_musd - budget_musd AS profit_musd,
         CASE WHEN budget_musd <> 0 THEN revenue_musd / budget_musd END AS roi,
         vote_count, discounts::DOUBLE / vote_count::DOUBLE AS vote_average,
         taxes::DOUBLE / 10e0 AS popularity, p_size::DOUBLE AS runtime, release_date
  FROM money
)"""


# --- raw events: the event table as untyped text, with faults ----------------------------

_EVENT_TYPE_MAP = {"click": "add_to_cart", "signup": "view"}


def raw_events(spark: SparkSession, sf_dir: str, number: str | None = None) -> DataFrame:
    """Every event as ten text columns plus an empty corrupt-row column (and its number)."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    kind = F.col("event_type")
    for given, meant in _EVENT_TYPE_MAP.items():
        kind = F.when(F.col("event_type") == given, F.lit(meant)).otherwise(kind)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return e.select(
        *([n.alias(number)] if number else []),
        F.when(n % 29 == 7, F.lit("   ")).otherwise(F.concat(F.lit(" e"), n.cast("string"))).alias("event_id"),
        F.when(n % 31 == 5, F.lit("not-a-time")).otherwise(stamp).alias("event_time"),
        F.when(n % 37 == 3, F.lit("u?")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(n % 41 == 2, F.lit("")).otherwise(F.concat(F.lit("s"), F.col("user_id").cast("string"))).alias("session_id"),
        F.when(n % 43 == 1, F.lit(" ")).otherwise(kind).alias("event_type"),
        F.when(n % 23 == 4, F.lit("")).otherwise(F.concat(F.lit("P"), (n % 12).cast("string"))).alias("product_id"),
        F.concat(F.lit("Product "), (n % 12).cast("string"), F.lit(" ")).alias("product_name"),
        F.when(n % 47 == 6, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C"), (n % 5).cast("string"))).alias("category"),
        F.when(n % 19 == 9, F.concat(F.lit("-"), F.col("value").cast("string")))
        .when(n % 53 == 8, F.lit("NaN"))
        .otherwise(F.col("value").cast("string"))
        .alias("price"),
        F.when(n % 17 == 11, F.lit("-1")).otherwise((n % 5 + 1).cast("string")).alias("quantity"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )


TYPED_EVENTS_SQL = """
typed_events AS (
  SELECT event_id AS n,
         CASE WHEN event_id % 29 <> 7 THEN 'e' || event_id END AS event_id,
         CASE WHEN event_id % 31 <> 5 THEN epoch_us(ts) END AS event_us,
         CASE WHEN event_id % 37 <> 3 THEN user_id::INTEGER END AS user_id,
         CASE WHEN event_id % 41 <> 2 THEN 's' || user_id END AS session_id,
         CASE WHEN event_id % 43 = 1 THEN NULL WHEN event_type = 'click' THEN 'add_to_cart'
              WHEN event_type = 'signup' THEN 'view' ELSE event_type END AS event_type,
         CASE WHEN event_id % 23 <> 4 THEN 'P' || (event_id % 12) END AS product_id,
         'Product ' || (event_id % 12) AS product_name,
         CASE WHEN event_id % 47 <> 6 THEN 'C' || (event_id % 5) END AS category,
         CASE WHEN event_id % 19 = 9 THEN -value WHEN event_id % 53 = 8 THEN 'NaN'::DOUBLE ELSE value END AS price,
         CASE WHEN event_id % 17 = 11 THEN -1 ELSE event_id % 5 + 1 END::INTEGER AS quantity
  FROM events
),
flagged AS (
  SELECT *, CASE WHEN event_id IS NULL THEN 'missing_event_id'
       WHEN event_us IS NULL THEN 'invalid_event_time'
       WHEN user_id IS NULL THEN 'invalid_user_id'
       WHEN event_type NOT IN ('view', 'add_to_cart', 'purchase') THEN 'invalid_event_type'
       WHEN product_id IS NULL THEN 'missing_product_id'
       WHEN price IS NULL OR price <= 0 THEN 'invalid_price'
       WHEN quantity IS NULL OR quantity <= 0 THEN 'invalid_quantity' END AS validation_reason
  FROM typed_events
),
strict AS (
  SELECT * REPLACE (CASE WHEN validation_reason IS NOT NULL THEN validation_reason
       WHEN session_id IS NULL THEN 'missing_session_id'
       WHEN event_type IS NULL THEN 'invalid_event_type'
       WHEN category IS NULL THEN 'missing_category'
       WHEN isnan(price) THEN 'invalid_price' END AS validation_reason)
  FROM flagged
)"""


# --- batch logs: events per stream and hour -----------------------------------------------


def batch_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (stream, hour): counts and a duration, as the two logs joined."""
    e = table(spark, sf_dir, "events")
    micros = X.epoch_micros(F.col("ts"), dict(e.dtypes)["ts"])
    return (
        e.select(
            F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("stream_id"),
            F.floor(micros / F.lit(3_600_000_000)).cast("bigint").alias("batch_id"),
            "ts",
            "event_id",
            "event_type",
        )
        .groupBy("stream_id", "batch_id")
        .agg(
            F.min("ts").alias("timestamp"),
            F.count(F.lit(1)).alias("received"),
            F.count_if(F.col("event_type") != "error").alias("inserted"),
            F.count_if(F.col("event_type") == "error").alias("rejected"),
            (F.lit(500) + F.sum(F.col("event_id") % 300)).cast("bigint").alias("batch_duration_ms"),
        )
        .withColumn(
            "processed_rows_per_second",
            F.col("received").cast("double") * F.lit(1000.0) / F.col("batch_duration_ms").cast("double"),
        )
        .withColumn("num_input_rows", F.col("received"))
    )


BATCH_LOGS_SQL = """
batch_logs AS (
  SELECT *, received::DOUBLE * 1000e0 / batch_duration_ms::DOUBLE AS processed_rows_per_second
  FROM (
    SELECT 's' || (user_id % 3) AS stream_id, epoch_us(ts) // 3600000000 AS batch_id, min(ts) AS timestamp,
           count(*) AS received, count(*) FILTER (event_type <> 'error') AS inserted,
           count(*) FILTER (event_type = 'error') AS rejected,
           (500 + sum(event_id % 300))::BIGINT AS batch_duration_ms
    FROM events GROUP BY ALL
  )
)"""
