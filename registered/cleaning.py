"""Nested-record cleaning over records built row by row from parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.book import register
from registered.frames import table
from sievewell import schemas
from sievewell.functions import expressions as X
from sievewell.operators import cleaning as C
from sievewell.plans import films as P
from sievewell.plans.scratch import scratch_path
from sievewell.sources.readers import read_json_document, read_ndjson
from sievewell.sources.writers import write_ndjson, write_single_csv

MIN_POPULATED = 18

# Every third fault sits on its own residue of the part key, in both languages.
_RAW_EXPRESSIONS = {
    "id": "CASE WHEN p_partkey % 17 = 16 THEN NULL ELSE p_partkey END",
    "title": "CASE WHEN p_partkey % 19 = 18 THEN NULL ELSE p_name END",
    "original_title": "p_name",
    "tagline": "CASE WHEN p_partkey % 3 = 0 THEN 'No Data' WHEN sparse THEN NULL ELSE p_brand END",
    "overview": "CASE WHEN p_partkey % 4 = 1 THEN '' WHEN sparse THEN NULL ELSE p_type END",
    "status": "CASE WHEN p_partkey % 10 = 3 THEN 'Planned' WHEN p_partkey % 31 = 7 THEN NULL ELSE 'Released' END",
    "release_date": "CASE WHEN p_partkey % 8 = 0 THEN '' WHEN p_partkey % 8 = 1 THEN 'soon' "
    "ELSE concat(cast(1990 + p_partkey % 30 AS string), '-06-', lpad(cast(1 + p_partkey % 28 AS string), 2, '0')) END",
    "original_language": "CASE WHEN sparse THEN NULL ELSE 'en' END",
    "homepage": "'h'",
    "imdb_id": "'t'",
    "poster_path": "CASE WHEN sparse THEN NULL ELSE concat('/', p_name) END",
    "adult": "false",
    "video": "false",
    "genres": "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN array() "
    "ELSE transform(split(p_name, ' '), x -> named_struct('id', 1L, 'name', x)) END",
    "production_countries": "array(named_struct('iso_3166_1', p_brand, 'name', p_brand))",
    "production_companies": "array(named_struct('name', p_type), named_struct('name', CAST(NULL AS string)), named_struct('name', p_brand))",
    "spoken_languages": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE array(named_struct('iso_639_1', 'en', 'name', 'English')) END",
    "belongs_to_collection": "CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE named_struct('id', CAST(p_size AS bigint), 'name', p_brand) END",
    "budget": "CASE WHEN p_partkey % 5 = 0 THEN 0L ELSE p_size * 1000000L END",
    "revenue": "CASE WHEN p_partkey % 6 = 0 THEN 0L ELSE CAST(round(p_retailprice * 100) AS bigint) * 10000 END",
    "runtime": "CAST(p_size % 4 AS bigint)",
    "vote_count": "CASE WHEN sparse THEN NULL ELSE CAST(p_size AS bigint) END",
    "vote_average": "CASE WHEN sparse THEN NULL ELSE p_size / 10D END",
    "popularity": "CAST(copy AS double)",
    "credits": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE named_struct("
    "'cast', CASE WHEN p_partkey % 9 = 1 THEN NULL ELSE transform(split(p_name, ' '), x -> named_struct('name', x, 'order', 1L, 'character', x)) END, "
    "'crew', CASE WHEN p_partkey % 9 = 2 THEN NULL ELSE array("
    "named_struct('name', p_brand, 'job', 'Producer', 'department', 'd'), "
    "named_struct('name', p_type, 'job', CASE WHEN p_size % 2 = 0 THEN 'Director' ELSE 'Writer' END, 'department', 'd'), "
    "named_struct('name', concat(p_type, ' II'), 'job', CASE WHEN p_size % 3 = 0 THEN 'Director' ELSE 'Editor' END, 'department', 'd')) END) END",
}


def raw_records(spark, sf_dir):
    """Two copies of every seventh part, told apart by popularity; otherwise one."""
    parts = table(spark, sf_dir, "part").withColumns(
        {
            "sparse": F.col("p_partkey") % 23 == 5,
            "copy": F.explode(F.when(F.col("p_partkey") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        }
    )
    return parts.select(
        *[
            F.expr(_RAW_EXPRESSIONS[f.name]).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_RECORD_SCHEMA.fields
        ]
    )


RAW_SQL = """
copies AS (SELECT *, p_partkey % 23 = 5 AS sparse, unnest(CASE WHEN p_partkey % 7 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM part),
shaped AS (
  SELECT CASE WHEN p_partkey % 17 <> 16 THEN p_partkey END AS id,
         CASE WHEN p_partkey % 19 <> 18 THEN p_name END AS title,
         CASE WHEN p_partkey % 3 = 0 OR sparse THEN NULL ELSE p_brand END AS tagline,
         CASE WHEN p_partkey % 8 > 1 THEN make_date(1990 + p_partkey % 30, 6, 1 + p_partkey % 28) END AS release_date,
         CASE WHEN p_partkey % 8 = 0 THEN '' WHEN p_partkey % 8 = 1 THEN 'soon' ELSE 'ok' END AS date_text,
         CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '' ELSE replace(p_name, ' ', '|') END AS genres,
         nullif(p_brand, 'Brand#1') AS belongs_to_collection,
         CASE WHEN NOT sparse THEN 'en' END AS original_language,
         CASE WHEN p_partkey % 5 <> 0 THEN p_size::DOUBLE END AS budget_musd,
         CASE WHEN p_partkey % 6 <> 0 THEN (round(p_retailprice * 100)::BIGINT * 10000)::DOUBLE / 1e6 END AS revenue_musd,
         p_type || '|' || p_brand AS production_companies, p_brand AS production_countries,
         CASE WHEN NOT sparse THEN p_size::BIGINT END AS vote_count,
         CASE WHEN NOT sparse THEN p_size::DOUBLE / 10e0 END AS vote_average,
         copy::DOUBLE AS popularity, nullif(p_size % 4, 0)::DOUBLE AS runtime,
         CASE WHEN p_partkey % 4 = 1 OR sparse THEN NULL ELSE p_type END AS overview,
         CASE WHEN p_size % 5 <> 0 THEN 'English' END AS spoken_languages,
         CASE WHEN NOT sparse THEN '/' || p_name END AS poster_path,
         CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN '' ELSE replace(p_name, ' ', '|') END AS "cast",
         CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN 0 ELSE len(string_split(p_name, ' ')) END::INTEGER AS cast_size,
         CASE WHEN p_partkey % 9 IN (0, 2) THEN NULL WHEN p_size % 2 = 0 THEN p_type WHEN p_size % 3 = 0 THEN p_type || ' II' END AS director,
         CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 2 THEN 0 ELSE 3 END::INTEGER AS crew_size,
         CASE WHEN p_partkey % 10 = 3 THEN 'Planned' WHEN p_partkey % 31 = 7 THEN NULL ELSE 'Released' END AS status
  FROM copies
),
derived AS (
  SELECT *, revenue_musd - budget_musd AS profit_musd, revenue_musd / budget_musd AS roi FROM shaped
),
counted AS (
  SELECT *, (id IS NOT NULL)::INT + (title IS NOT NULL)::INT + (tagline IS NOT NULL)::INT + (overview IS NOT NULL)::INT
    + (status IS NOT NULL)::INT + (release_date IS NOT NULL)::INT + (original_language IS NOT NULL)::INT + (poster_path IS NOT NULL)::INT
    + (genres IS NOT NULL)::INT + 1 + 1 + (spoken_languages IS NOT NULL)::INT + (belongs_to_collection IS NOT NULL)::INT
    + 2 * (budget_musd IS NOT NULL)::INT + 2 * (revenue_musd IS NOT NULL)::INT + (profit_musd IS NOT NULL)::INT + (roi IS NOT NULL)::INT
    + (runtime IS NOT NULL)::INT + (vote_count IS NOT NULL)::INT + (vote_average IS NOT NULL)::INT + 1
    + ("cast" IS NOT NULL)::INT + (cast_size IS NOT NULL)::INT + (director IS NOT NULL)::INT + (crew_size IS NOT NULL)::INT AS populated,
    row_number() OVER (PARTITION BY id ORDER BY popularity DESC) AS place
  FROM derived
)"""

_CLEAN_NAMES = ", ".join(f'"{f.name}"' for f in schemas.CLEAN_SCHEMA.fields)
CLEAN_SQL = f"""
WITH {RAW_SQL}
SELECT {_CLEAN_NAMES} FROM counted
WHERE id IS NOT NULL AND place = 1 AND title IS NOT NULL AND populated >= {MIN_POPULATED} AND status = 'Released'"""


def _prefer():
    return [F.col("popularity").desc()]


@register(
    "clean_chain",
    "PRJ1 PRJ2 PRJ3 PRJ4 PRJ5 PRJ6 PRJ7 PRJ8 PRJ9 PRJ10 PRJ11 PRJ12 PRJ13 PRJ14 PRJ15 PRJ16 PRJ30 FLT1 FLT2 FLT3 DED1",
    CLEAN_SQL,
)
def clean_chain(spark, sf_dir):
    return P.clean_records(raw_records(spark, sf_dir), prefer=_prefer(), min_populated=MIN_POPULATED)


@register("ndjson_round_trip", "SRC1 SNK2 PRJ30", CLEAN_SQL)
def ndjson_round_trip(spark, sf_dir):
    """The raw records through line-delimited files and back under the fixed schema."""
    path = write_ndjson(raw_records(spark, sf_dir), scratch_path(spark, "ndjson"))
    return P.clean_records(read_ndjson(spark, path), prefer=_prefer(), min_populated=MIN_POPULATED)


@register(
    "json_document_scan",
    "SRC2",
    "SELECT r_regionkey::BIGINT AS id, r_name AS title, string_agg(n_name, '|' ORDER BY n_nationkey) AS genres "
    "FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL",
)
def json_document_scan(spark, sf_dir):
    """One JSON array per file: a row holding the whole document, read back as records.

    Regions and nations have a fixed size at every scale, which is what makes
    a one-document file sensible.
    """
    nations = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("members")
    )
    regions = table(spark, sf_dir, "region")
    records = regions.join(nations, regions["r_regionkey"] == nations["n_regionkey"]).select(
        F.col("r_regionkey").cast("bigint").alias("id"),
        F.col("r_name").alias("title"),
        F.transform("members", lambda m: F.struct(F.lit(1).cast("bigint").alias("id"), m["n_name"].alias("name"))).alias("genres"),
    )
    path = scratch_path(spark, "document")
    document = records.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    document.coalesce(1).write.text(path)
    return C.flatten_arrays(read_json_document(spark, path), ["genres"]).select("id", "title", "genres")


@register(
    "single_csv_export",
    "SNK1 CTL2",
    "SELECT n_name, n_regionkey::INTEGER AS n_regionkey FROM nation",
)
def single_csv_export(spark, sf_dir):
    folder = write_single_csv(table(spark, sf_dir, "nation").select("n_name", "n_regionkey"), scratch_path(spark, "export"))
    return spark.read.schema("n_name string, n_regionkey int").option("header", True).csv(folder)


@register(
    "cleaning_funnel",
    "VAL5",
    f"""
WITH {RAW_SQL},
judged AS (
  SELECT CASE WHEN id IS NULL OR place > 1 OR title IS NULL THEN 'duplicate_or_unknown'
              WHEN populated < {MIN_POPULATED} THEN 'sparse'
              WHEN status IS DISTINCT FROM 'Released' THEN 'unwanted_status' ELSE 'kept' END AS drop_stage
  FROM counted
)
SELECT drop_stage, count(*) AS n FROM judged GROUP BY ALL""",
)
def cleaning_funnel(spark, sf_dir):
    shaped = P.shape_records(raw_records(spark, sf_dir)).withColumn("__newest", -F.col("popularity"))
    columns = [c for c in shaped.columns if c != "__newest"]
    return C.cleaning_funnel(shaped, prefer=["__newest"], minimum=MIN_POPULATED, columns=columns)


@register(
    "nested_names",
    "PRJ2 PRJ3 PRJ4",
    f"""
WITH {RAW_SQL}
SELECT popularity, genres, belongs_to_collection, production_companies, "cast" FROM counted""",
)
def nested_names(spark, sf_dir):
    flat = C.flatten_arrays(C.flatten_structs(raw_records(spark, sf_dir), P.STRUCTS), ["genres", "production_companies"])
    return C.extract_people(flat).select("popularity", "genres", "belongs_to_collection", "production_companies", "cast")


@register(
    "nested_first_match",
    "PRJ5 PRJ6",
    f"WITH {RAW_SQL} SELECT id, popularity, director FROM counted",
)
def nested_first_match(spark, sf_dir):
    return raw_records(spark, sf_dir).select(
        "id", "popularity", X.first_match("credits.crew", lambda p: p["job"] == "Director").alias("director")
    )


@register(
    "nested_sizes",
    "PRJ7 PRJ8",
    f"WITH {RAW_SQL} SELECT id, popularity, cast_size, crew_size FROM counted",
)
def nested_sizes(spark, sf_dir):
    return C.extract_people(raw_records(spark, sf_dir)).select("id", "popularity", "cast_size", "crew_size")


@register(
    "typed_values",
    "PRJ9 PRJ10 PRJ11 PRJ12",
    f"WITH {RAW_SQL} SELECT id, popularity, release_date, runtime, tagline, overview FROM counted",
)
def typed_values(spark, sf_dir):
    """Conversions from text: every number first turned into a string."""
    raw = raw_records(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in P.NUMBERS})
    typed = C.coerce_types(raw, P.NUMBERS, P.DAYS)
    nulled = C.null_sentinels(typed, P.ZERO_IS_UNKNOWN, P.PLACEHOLDER_COLUMNS, P.PLACEHOLDERS)
    return nulled.select("id", "popularity", "release_date", "runtime", "tagline", "overview")


@register(
    "money_metrics",
    "PRJ13 PRJ14 PRJ15",
    """
SELECT o_orderkey, o_totalprice / 1e3 AS revenue_k, o_custkey::DOUBLE / 1e3 AS budget_k,
       o_totalprice / 1e3 - o_custkey::DOUBLE / 1e3 AS profit_k,
       CASE WHEN o_custkey <> 0 THEN (o_totalprice / 1e3) / (o_custkey::DOUBLE / 1e3) END AS ratio
FROM orders""",
)
def money_metrics(spark, sf_dir):
    orders = C.money_metrics(
        table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 1e3, ("budget_k", "revenue_k", "profit_k", "ratio")
    )
    return orders.select("o_orderkey", "revenue_k", "budget_k", "profit_k", "ratio")


@register(
    "conform_columns",
    "PRJ1 PRJ16",
    """
SELECT c_custkey AS id, c_name AS title, NULL::DATE AS release_date, NULL::DOUBLE AS roi FROM customer""",
)
def conform_columns(spark, sf_dir):
    wanted = schemas.struct_of(id="long", title="string", release_date="date", roi="double")
    customers = table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "title"})
    return C.conform(C.drop_columns(customers, ["c_acctbal", "not_there"]), wanted)


@register(
    "sparse_rows",
    "FLT3",
    f"WITH {RAW_SQL} SELECT id, popularity, title FROM counted WHERE populated >= {MIN_POPULATED}",
)
def sparse_rows(spark, sf_dir):
    return C.drop_sparse(P.shape_records(raw_records(spark, sf_dir)), MIN_POPULATED).select("id", "popularity", "title")


@register(
    "status_rows",
    "FLT1 FLT2",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL",
)
def status_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return C.require(C.keep_status(orders, "F", "o_orderstatus"), ["o_orderkey", "o_totalprice"])


@register(
    "first_item_per_order",
    "DED1",
    """
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) = 1""",
)
def first_item_per_order(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return C.one_per_key(items, "l_orderkey", ["l_linenumber", "l_partkey", "l_extendedprice"])
