from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sievewell.functions import expressions as X

from samples import record


def value(spark, expression, **columns):
    row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} string" for k in columns)) if columns else spark.range(1)
    return row.select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "text, wanted",
    [("  a b ", "a b"), ("   ", None), ("", None), (None, None), ("\t", "\t")],
)
def test_blank_to_null_strips_spaces_only(either_mode, text, wanted):
    assert value(either_mode, X.blank_to_null(F.col("x")), x=text) == wanted


@pytest.mark.parametrize("text, strict, lenient", [("3", 3, 3), ("2.7", None, 2), ("x", None, None), (None, None, None)])
def test_integers_from_text(either_mode, text, strict, lenient):
    assert value(either_mode, X.to_number(F.col("x"), "int"), x=text) == strict
    assert value(either_mode, X.to_int_truncating(F.col("x")), x=text) == lenient


@pytest.mark.parametrize("text, wanted", [("2011-05-06", dt.date(2011, 5, 6)), ("", None), ("soon", None), (None, None)])
def test_days(either_mode, text, wanted):
    assert value(either_mode, X.to_day(F.col("x")), x=text) == wanted


@pytest.mark.parametrize(
    "text, exact, widened",
    [
        ("2024-03-05T10:20:30.5+00:00", True, True),
        ("2024-03-05T10:20:30.123456Z", True, True),
        ("2024-03-05T10:20:30+00:00", False, True),
        ("yesterday", False, False),
    ],
)
def test_instants_need_a_fraction_unless_widened(either_mode, text, exact, widened):
    one = X.to_instant(F.col("x"), X.EVENT_TIME_PATTERN)
    two = X.to_instant(F.col("x"), X.EVENT_TIME_PATTERN, X.EVENT_TIME_WHOLE_SECOND_PATTERN)
    assert (value(either_mode, one, x=text) is not None) == exact
    assert (value(either_mode, two, x=text) is not None) == widened


@pytest.mark.parametrize("text, wanted", [("No Data", None), ("", None), (None, None), ("fine", "fine")])
def test_placeholders(either_mode, text, wanted):
    assert value(either_mode, X.placeholder_to_null(F.col("x"), ["No Data", ""]), x=text) == wanted


def test_ratio_is_null_for_zero_or_missing_bottom(either_mode):
    assert value(either_mode, X.guarded_ratio(F.lit(3.0), F.lit(2.0))) == 1.5
    assert value(either_mode, X.guarded_ratio(F.lit(3.0), F.lit(0.0))) is None
    assert value(either_mode, X.guarded_ratio(F.lit(3.0), F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("text, wanted", [("a|b", "a"), ("a", "a"), (None, "Unknown"), ("", ""), ("|b", "")])
def test_first_token(spark, text, wanted):
    assert value(spark, X.first_token(F.col("x")), x=text) == wanted


def test_nested_fields(raw_frame, either_mode):
    df = raw_frame(
        record(1),
        record(2, genres=None, credits=None),
        record(3, genres=[], credits={"cast": None, "crew": None}),
        record(4, genres=[{"id": 1, "name": None}, {"id": 2, "name": "Drama"}], crew=[("E", "Writer")]),
        record(5, crew=[("One", "Director"), ("Two", "Director")]),
    )
    rows = {
        r.id: r
        for r in df.select(
            "id",
            X.joined_field("genres").alias("genres"),
            X.first_match("credits.crew", lambda p: p["job"] == "Director").alias("lead"),
            X.size_under("credits", "credits.crew").alias("crew"),
        ).collect()
    }
    assert [rows[i].genres for i in range(1, 6)] == ["Comedy|Science Fiction", None, "", "Drama", "Comedy|Science Fiction"]
    assert [rows[i].lead for i in range(1, 6)] == ["Cy Cedar", None, None, None, "One"]
    assert [rows[i].crew for i in range(1, 6)] == [2, None, 0, 1, 2]


def test_epoch_micros_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            # 02:30 does not exist in New York on that day.
            df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000001' AS t")
            assert df.select(X.epoch_micros(F.col("t"), "timestamp_ntz").alias("v")).first().v == 1_710_037_800_000_001
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
