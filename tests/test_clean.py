from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from larder.functions.columns import composite_key, locale_number, not_blank, within_bounds
from larder.operators.clean import clean_products, dedupe_by_key, validate_columns
from larder.schema import FILE_LAYOUT, TABLE_LAYOUT

NUMBERS = [
    ("4,5", 4.5, 4.5),
    (" 7 ", 7.0, 7.0),
    ("\t8", 8.0, 8.0),
    ("1e2", 100.0, 100.0),
    (".5", 0.5, 0.5),
    ("5.", 5.0, 5.0),
    ("+3", 3.0, 3.0),
    ("5d", 5.0, 5.0),
    ("5f", 5.0, 5.0),
    ("1,234", 1.234, 1.234),
    ("1,234,5", None, None),
    ("0x10", None, None),
    ("abc", None, None),
    ("", None, None),
    ("1_0", None, None),
    (None, None, None),
    ("NaN", math.nan, None),
    ("Infinity", math.inf, None),
    ("-inf", -math.inf, None),
    ("-1", -1.0, None),
    ("100.01", 100.01, None),
    ("0", 0.0, 0.0),
    ("100", 100.0, 100.0),
    ("-0", -0.0, 0.0),
]


def test_numbers_parse_and_are_kept_within_closed_bounds(spark):
    frame = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(NUMBERS)], "i int, t string")
    number = locale_number(F.col("t"))
    rows = frame.select("i", number.alias("n"), within_bounds(number, 0.0, 100.0).alias("k")).collect()
    for row in rows:
        text, parsed, kept = NUMBERS[row["i"]]
        if parsed is not None and math.isnan(parsed):
            assert math.isnan(row["n"]), text
        else:
            assert row["n"] == parsed, text
        assert row["k"] == kept, text
        if kept == 0.0:
            assert math.copysign(1.0, row["k"]) == 1.0, text


def test_blank_and_key_expressions(spark):
    frame = spark.createDataFrame([("a", "b"), (None, "b"), ("  ", "b"), ("", None)], "x string, y string")
    rows = frame.select(not_blank(F.col("x")).alias("f"), composite_key(F.col("x"), F.col("y")).alias("k"))
    assert [tuple(r) for r in rows.collect()] == [
        (True, "a:b"), (False, None), (False, "  :b"), (False, None)
    ]


def test_cleaning_casts_filters_and_keeps_one_row_per_key(file_products):
    other = ["6"] * 8
    rows = file_products(
        ("  a7 ", " Rye bread  ", "Breads", "231", "1,9", "0,3", "46", "4,1", "6", "7,5", "1.15"),
        ("b8", "Half known", None, "1000.5", "-0,1", None, "", "?", None, "12", None),
        ("", "Empty key", "Breads", *other),
        ("   ", "Blank key", "Breads", *other),
        (None, "Null key", "Breads", *other),
        ("c9", "Nothing valid", "Breads", "-1", "x", "", None, "NaN", "101", "-5", "inf"),
    )
    found = {row["code"]: row for row in clean_products(rows).collect()}
    assert set(found) == {"a7", "b8"}
    assert found["a7"]["product_name"] == "Rye bread"
    assert (found["a7"]["fat_100g"], found["a7"]["salt_100g"]) == (1.9, 1.15)
    assert [found["b8"][name] for name in FILE_LAYOUT.features] == [None] * 6 + [12.0, None]
    assert found["b8"]["categories"] is None


def test_an_unmeasured_row_does_not_hide_a_measured_one(file_products):
    rows = file_products(
        ("1", "A first", "", *["x"] * 8),
        ("1", "B second", "", "10", *[None] * 7),
    )
    assert [row["product_name"] for row in clean_products(rows).collect()] == ["B second"]


def test_survivor_is_the_smallest_row_with_nulls_first(file_products):
    row = ("1", "Same", "Same", "5", "1", "1", "1", "1", "1", "1", "1")
    smaller = ("1", "Same", None, "9", "1", "1", "1", "1", "1", "1", "1")
    for rows in ([row, smaller, row], [smaller, row]):
        kept = clean_products(file_products(*rows)).collect()
        assert [(r["categories"], r["energy-kcal_100g"]) for r in kept] == [(None, 9.0)]


def test_dedupe_by_a_chosen_order(spark):
    frame = spark.createDataFrame([("k", 2, "a"), ("k", 1, "b"), ("k", 1, "c")], "code string, at int, v string")
    assert [tuple(r) for r in dedupe_by_key(frame, order=["at"]).collect()] == [("k", 1, "b")]
    assert dedupe_by_key(frame).columns == ["code", "at", "v"]


def test_text_handling_per_layout(spark):
    row = ("1", " x ", None, "1", *[None] * 7)
    table = spark.createDataFrame([row], TABLE_LAYOUT.raw_schema)
    assert clean_products(table, TABLE_LAYOUT).first()["product_name"] == " x "


def test_missing_columns_are_named_in_order(spark):
    frame = spark.createDataFrame([("1",)], "code string")
    with pytest.raises(ValueError, match="missing columns: carbohydrates_100g, categories, energy-kcal"):
        validate_columns(frame)
    with pytest.raises(ValueError, match="missing columns"):
        clean_products(frame)
    assert len(FILE_LAYOUT.columns) == 11
