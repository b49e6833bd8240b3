"""Explicit schemas.  No reader in this library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the published column contracts.
CORRUPT_COLUMN = "_corrupt_record"

EVENT_COLUMNS = (
    "event_id", "event_time", "user_id", "session_id", "event_type",
    "product_id", "product_name", "category", "price", "quantity",
)
EVENT_TYPES = ("view", "add_to_cart", "purchase")


def struct_of(**fields: str | T.DataType) -> T.StructType:
    """A schema from name=type; text types are Spark's JSON names (``long``, ``decimal(10,2)``)."""
    schema = T.StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


def list_of(**fields: str | T.DataType) -> T.ArrayType:
    """An array of structs."""
    return T.ArrayType(struct_of(**fields))


RAW_RECORD_SCHEMA = struct_of(
    id="long",
    title="string",
    original_title="string",
    tagline="string",
    overview="string",
    status="string",
    release_date="string",
    original_language="string",
    homepage="string",
    imdb_id="string",
    poster_path="string",
    adult="boolean",
    video="boolean",
    genres=list_of(id="long", name="string"),
    production_countries=list_of(iso_3166_1="string", name="string"),
    production_companies=list_of(name="string"),
    spoken_languages=list_of(iso_639_1="string", name="string"),
    belongs_to_collection=struct_of(id="long", name="string"),
    budget="long",
    revenue="long",
    runtime="long",
    vote_count="long",
    vote_average="double",
    popularity="double",
    credits=struct_of(
        cast=list_of(name="string", order="long", character="string"),
        crew=list_of(name="string", job="string", department="string"),
    ),
)

CLEAN_SCHEMA = struct_of(
    id="long",
    title="string",
    tagline="string",
    release_date="date",
    genres="string",
    belongs_to_collection="string",
    original_language="string",
    budget_musd="double",
    revenue_musd="double",
    profit_musd="double",
    roi="double",
    production_companies="string",
    production_countries="string",
    vote_count="long",
    vote_average="double",
    popularity="double",
    runtime="double",
    overview="string",
    spoken_languages="string",
    poster_path="string",
    cast="string",
    cast_size="integer",
    director="string",
    crew_size="integer",
)

RAW_EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*EVENT_COLUMNS, CORRUPT_COLUMN)]
)

SINK_COLUMNS = (*EVENT_COLUMNS, "total_amount", "processing_time")

SINK_SCHEMA = struct_of(
    event_id="string",
    event_time="timestamp",
    user_id="integer",
    session_id="string",
    event_type="string",
    product_id="string",
    product_name="string",
    category="string",
    price="decimal(10,2)",
    quantity="integer",
    total_amount="decimal(10,2)",
    processing_time="timestamp",
    ingested_at="timestamp",
)

BATCH_KEYS = ("stream_id", "batch_id")
BATCH_KEY_SCHEMA = struct_of(stream_id="string", batch_id="long")

PROGRESS_SCHEMA = struct_of(
    batch_id="long",
    timestamp="string",
    num_input_rows="long",
    input_rows_per_second="double",
    processed_rows_per_second="double",
    batch_duration_ms="long",
)
COUNTS_SCHEMA = struct_of(batch_id="long", received="long", inserted="long", rejected="long")


def with_batch_keys(schema: T.StructType) -> T.StructType:
    """``schema`` plus the (stream_id, batch_id) partition columns."""
    names = set(schema.fieldNames())
    return T.StructType(schema.fields + [f for f in BATCH_KEY_SCHEMA.fields if f.name not in names])
