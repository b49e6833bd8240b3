"""Column expressions that behave the same with ANSI mode on or off.

Spark 4 sessions raise on a bad cast by default; the cleaning semantics here
need NULL, so every conversion goes through a ``try_*`` form.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp patterns of the event feed and of the progress log.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
EVENT_TIME_WHOLE_SECOND_PATTERN = "yyyy-MM-dd'T'HH:mm:ssXXX"
PROGRESS_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

LIST_SEPARATOR = "|"


def blank_to_null(value: Column) -> Column:
    """PRJ17: strip spaces (spaces only, tabs stay) and turn '' into NULL."""
    return F.nullif(F.trim(value), F.lit(""))


def zero_to_null(value: Column) -> Column:
    """PRJ11: zero stands for 'unknown'."""
    return F.nullif(value, F.lit(0))


def placeholder_to_null(value: Column, placeholders: Sequence[str]) -> Column:
    """PRJ12: listed texts stand for 'unknown'."""
    return F.when(~value.isin(*placeholders), value)


def to_number(value: Column, spark_type: str) -> Column:
    """PRJ9/PRJ19/PRJ20: numeric conversion, NULL when it does not parse."""
    return value.try_cast(spark_type)


def to_int_truncating(value: Column) -> Column:
    """PRJ19, lenient form: '2.7' becomes 2 (plain ``try_cast`` gives NULL)."""
    return value.try_cast("decimal(38,18)").try_cast("int")


def to_day(value: Column) -> Column:
    """PRJ10: date, NULL for '' and anything unparseable."""
    return value.try_cast("date")


def to_instant(value: Column, *patterns: str) -> Column:
    """PRJ18/PRJ31: timestamp by the first pattern that fits, else NULL."""
    tries = [F.try_to_timestamp(value, F.lit(p)) for p in patterns]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def scaled(value: Column, unit: float) -> Column:
    """PRJ13: express an amount in ``unit``s."""
    return value / F.lit(float(unit))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """PRJ15/PRJ29: quotient, NULL when the bottom is NULL or zero."""
    return F.try_divide(top, bottom)


def struct_field(struct_column: str, field: str = "name") -> Column:
    """PRJ2: one field of a struct."""
    return F.col(f"{struct_column}.{field}")


def joined_field(array_path: str, field: str = "name", separator: str = LIST_SEPARATOR) -> Column:
    """PRJ3/PRJ4: one field of every element, joined; a NULL array stays NULL.

    Dotted access rather than a lambda, so that a columnar source reads only
    that leaf.
    """
    return F.when(F.col(array_path).isNotNull(), F.concat_ws(separator, F.col(f"{array_path}.{field}")))


def first_match(array_path: str, keep: Callable[[Column], Column], field: str = "name") -> Column:
    """PRJ5+PRJ6: ``field`` of the first element satisfying ``keep``, or NULL."""
    return F.get(F.filter(F.col(array_path), keep), F.lit(0))[field]


def size_under(parent_path: str, array_path: str) -> Column:
    """PRJ7: element count; 0 for a missing array, NULL for a missing parent."""
    counted = F.when(F.col(array_path).isNull(), F.lit(0)).otherwise(F.size(F.col(array_path)))
    return F.when(F.col(parent_path).isNotNull(), counted)


def first_token(value: Column, separator: str = LIST_SEPARATOR, missing: str = "Unknown") -> Column:
    """PRJ26: text before the first separator; ``missing`` for NULL."""
    return F.substring_index(F.coalesce(value, F.lit(missing)), separator, 1)


def present(value: Column) -> Column:
    """PRJ24: presence flag."""
    return value.isNotNull()


def flag_label(flag: Column, yes: str, no: str) -> Column:
    """PRJ28: boolean to text."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def line_amount(valid: Column, unit_price: Column, quantity: Column) -> Column:
    """PRJ21: price x quantity to two decimals, only for valid rows."""
    return F.when(valid, F.round(unit_price * quantity, 2))


def seconds_from_ms(value: Column) -> Column:
    """PRJ29: milliseconds to seconds."""
    return value / F.lit(1000.0)


def epoch_micros(value: Column, spark_type: str) -> Column:
    """Microseconds since 1970, for both timestamp types.

    A zoneless timestamp is measured against a zoneless origin so the session
    time zone plays no part.
    """
    if spark_type == "timestamp_ntz":
        span = value - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        seconds = span.cast("interval second").cast("decimal(18,6)")
        return (seconds * F.lit(1_000_000)).cast("bigint")
    return F.unix_micros(value)
