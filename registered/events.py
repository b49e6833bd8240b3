"""Typing, validation and tallies of event rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registered.book import register
from registered.frames import TYPED_EVENTS_SQL, raw_events, table
from sievewell.functions import expressions as X
from sievewell.operators import summaries as S
from sievewell.operators import validation as V
from sievewell.plans.scratch import scratch_path
from sievewell.schemas import EVENT_COLUMNS
from sievewell.sources.readers import read_event_csv

_TYPED = "event_id, event_us, user_id, session_id, event_type, product_id, product_name, category, price, quantity"
_AMOUNT = "CASE WHEN validation_reason IS NULL THEN round(price * quantity, 2) END AS total_amount"


def typed_columns(df, *more: str):
    """Oracle-comparable form: the instant as microseconds, no wall-clock columns."""
    return df.withColumn("event_us", F.unix_micros("event_time")).select(
        "event_id", "event_us", "user_id", "session_id", "event_type", "product_id", "product_name", "category",
        "price", "quantity", *more,
    )


@register(
    "events_typed",
    "PRJ17 PRJ18 PRJ19 PRJ20",
    f"WITH {TYPED_EVENTS_SQL} SELECT {_TYPED} FROM typed_events",
)
def events_typed(spark, sf_dir):
    return typed_columns(V.type_events(raw_events(spark, sf_dir)))


@register(
    "events_clean",
    "VAL1 VAL1a VAL1b VAL1c VAL1d VAL1e VAL1f VAL1g VAL1h VAL3 PRJ21",
    f"""
WITH {TYPED_EVENTS_SQL}
SELECT {_TYPED}, validation_reason, validation_reason IS NULL AS is_valid, {_AMOUNT} FROM flagged""",
)
def events_clean(spark, sf_dir):
    return typed_columns(V.clean_events(raw_events(spark, sf_dir)), "validation_reason", "is_valid", "total_amount")


@register(
    "events_valid",
    "FLT9 VAL3 PRJ21",
    f"WITH {TYPED_EVENTS_SQL} SELECT {_TYPED}, {_AMOUNT} FROM flagged WHERE validation_reason IS NULL",
)
def events_valid(spark, sf_dir):
    valid, _ = V.split_valid(V.clean_events(raw_events(spark, sf_dir)))
    return typed_columns(valid, "total_amount")


@register(
    "events_rejected",
    "FLT9 VAL1",
    f"WITH {TYPED_EVENTS_SQL} SELECT {_TYPED}, validation_reason FROM flagged WHERE validation_reason IS NOT NULL",
)
def events_rejected(spark, sf_dir):
    _, rejected = V.split_valid(V.clean_events(raw_events(spark, sf_dir)))
    return typed_columns(rejected, "validation_reason")


@register(
    "reject_reasons",
    "AGG6 SRT2",
    f"WITH {TYPED_EVENTS_SQL} SELECT validation_reason, count(*) AS n FROM flagged WHERE validation_reason IS NOT NULL GROUP BY ALL",
)
def reject_reasons(spark, sf_dir):
    return S.reason_tally(V.clean_events(raw_events(spark, sf_dir)))


@register(
    "contract_reasons",
    "VAL2 AGG6",
    f"WITH {TYPED_EVENTS_SQL} SELECT validation_reason, count(*) AS n FROM strict WHERE validation_reason IS NOT NULL GROUP BY ALL",
)
def contract_reasons(spark, sf_dir):
    return S.reason_tally(V.clean_events(raw_events(spark, sf_dir), V.contract_rules()))


@register(
    "event_outcomes",
    "AGG7",
    f"""
WITH {TYPED_EVENTS_SQL}
SELECT count(*) AS received, count(*) FILTER (validation_reason IS NULL) AS valid,
       count(*) FILTER (validation_reason IS NOT NULL) AS rejected FROM flagged""",
)
def event_outcomes(spark, sf_dir):
    return S.outcome_counts(V.clean_events(raw_events(spark, sf_dir)))


@register("event_type_tally", "AGG11", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def event_type_tally(spark, sf_dir):
    return S.tally(table(spark, sf_dir, "events"), "event_type")


@register(
    "lenient_quantities",
    "PRJ19",
    "SELECT event_id, trunc(value)::INTEGER AS lenient, NULL::INTEGER AS strict FROM events",
)
def lenient_quantities(spark, sf_dir):
    """Fractional texts as integers: truncated in the lenient form, NULL in the strict one."""
    texts = table(spark, sf_dir, "events").withColumn("text", F.col("value").cast("string"))
    return texts.select(
        "event_id", X.to_int_truncating(F.col("text")).alias("lenient"), X.to_number(F.col("text"), "int").alias("strict")
    )


_CSV_SQL = f"""
WITH {TYPED_EVENTS_SQL}
SELECT CASE WHEN n % 59 = 13 THEN 'corrupt_csv_row' ELSE validation_reason END AS validation_reason, count(*) AS n
FROM flagged GROUP BY ALL"""


def staged_event_csv(spark, sf_dir, corrupt: bool = True, files: int | None = None) -> str:
    """The raw events as header CSV files; unquoted, so a comma in a field makes a row too wide."""
    raw = raw_events(spark, sf_dir, number="n")
    if corrupt:
        name = F.when(F.col("n") % 59 == 13, F.lit("a,b")).otherwise(F.col("product_name"))
        raw = raw.withColumn("product_name", name)
    out = raw.select(*EVENT_COLUMNS)
    if files:
        out = out.repartition(files)
    path = scratch_path(spark, "events-csv")
    out.write.option("header", True).option("quote", "\u0000").option("emptyValue", "").option("nullValue", "").csv(path)
    return path


@register("event_csv_scan", "SRC4 VAL1a", _CSV_SQL)
def event_csv_scan(spark, sf_dir):
    """Event files with rows one field too wide, told apart from ordinary faults."""
    cleaned = V.clean_events(read_event_csv(spark, staged_event_csv(spark, sf_dir)))
    return S.tally(cleaned, "validation_reason")
