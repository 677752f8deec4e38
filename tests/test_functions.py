from __future__ import annotations

import datetime
import statistics

import pytest
from pyspark.sql import functions as F

from roostline.functions import (
    parse_amenities,
    resolve_alias,
    round_half_up,
    sample_stddev,
    surrogate_key,
    vocabulary,
    widen,
    years_between,
)


def one(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame.select(column).first()[0]


def test_surrogate_key_of_the_documented_input(spark):
    key = one(spark, surrogate_key("a", "b"), a=123, b=datetime.date(2022, 1, 1))
    assert key == "3d9e9bd526c734f0a75cf64b6a313d04"


def test_surrogate_key_keeps_the_place_of_a_null(spark):
    left = one(spark, surrogate_key(F.lit(None).cast("int"), F.lit("x")))
    right = one(spark, surrogate_key(F.lit("x"), F.lit(None).cast("int")))
    assert left != right


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('["Wifi", " Pool ", "Wifi"]', ["Pool", "Wifi"]),
        ("[]", None),
        ("[null]", []),
        ('["A", null]', ["A"]),
        (None, None),
        ("[1, true]", ["1", "true"]),
    ],
)
def test_parse_amenities(spark, text, expected):
    column = parse_amenities(F.lit(text).cast("string"))
    assert one(spark, column) == expected


def test_malformed_json_stops_unless_permissive(spark):
    frame = spark.createDataFrame([('["Wifi"',)], "a string")
    with pytest.raises(Exception, match="(?i)malformed"):
        frame.select(parse_amenities("a")).collect()
    assert frame.select(parse_amenities("a", "permissive")).first()[0] is None


def test_vocabulary_is_sorted_and_distinct(spark):
    frame = spark.createDataFrame(
        [(["b", "a"],), (["a"],), ([],), (None,)], "amenities array<string>"
    )
    assert vocabulary(frame) == ["a", "b"]


def test_widen_keeps_null_for_unknown_and_the_place_of_the_array(spark):
    frame = spark.createDataFrame(
        [(1, ["A/C"], "x"), (2, None, "y"), (3, [], "z")],
        "id int, amenities array<string>, tail string",
    )
    wide = widen(frame, ["A/C", "Wi.Fi `x`"])
    assert wide.columns == ["id", "A/C", "Wi.Fi `x`", "tail"]
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [
        (1, True, False, "x"),
        (2, None, None, "y"),
        (3, False, False, "z"),
    ]


def test_names_that_differ_by_case_need_a_case_sensitive_session(spark):
    frame = spark.createDataFrame([(["WiFi"],)], "amenities array<string>")
    spark.conf.set("spark.sql.caseSensitive", "false")
    try:
        with pytest.raises(ValueError, match="caseSensitive"):
            widen(frame, ["WiFi", "Wifi"])
    finally:
        spark.conf.set("spark.sql.caseSensitive", "true")
    assert tuple(widen(frame, ["WiFi", "Wifi"]).first()) == (True, False)


def test_resolve_alias_takes_the_first_known_spelling():
    assert resolve_alias(("AC", "A/C"), ["A/C", "Pool"]) == "A/C"
    assert resolve_alias(("AC",), ["Pool"]) is None


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [(1.005, 2, 1.01), (-1.005, 2, -1.01), (2.675, 2, 2.68), (23 / 800 * 100, 2, 2.88)],
)
def test_rounding_is_decimal_and_half_up(spark, value, digits, expected):
    assert one(spark, round_half_up(F.lit(value), digits)) == expected


def test_sample_stddev_from_sums_of_cents(spark):
    prices = [100.0, 120.5, 99.99, 250.0]
    frame = spark.createDataFrame([(p,) for p in prices], "p double").withColumn(
        "c", (F.col("p") * 100).cast("decimal(18,0)")
    )
    value = frame.agg(
        sample_stddev(
            F.sum("c").cast("decimal(38,0)"),
            F.sum(F.col("c") * F.col("c")).cast("decimal(38,0)"),
            F.count("c"),
        )
    ).first()[0]
    assert value == pytest.approx(statistics.stdev(prices))
    single = frame.limit(1).agg(
        sample_stddev(
            F.sum("c").cast("decimal(38,0)"),
            F.sum(F.col("c") * F.col("c")).cast("decimal(38,0)"),
            F.count("c"),
        )
    )
    assert single.first()[0] is None


def test_years_are_calendar_boundaries(spark):
    span = years_between(F.lit(datetime.date(2021, 12, 31)), F.lit(datetime.date(2022, 1, 1)))
    assert one(spark, span) == 1
