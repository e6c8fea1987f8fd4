from __future__ import annotations

import math

import pytest

from larder.operators.prepare import (
    assemble,
    impute_median,
    prepare_products,
    spread,
    standardize,
)
from larder.schema import FEATURE_SLOTS, PREPARED_SCHEMA, TABLE_LAYOUT


def test_imputation_fills_null_and_nan_with_the_lower_median(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (math.nan,)], "x double")
    filled = [row["x__imputed"] for row in impute_median(frame, ["x"]).collect()]
    assert sorted(filled) == [1.0, 2.0, 2.0, 2.0, 3.0, 4.0]
    approximate = impute_median(frame, ["x"], exact=False)
    assert approximate.columns == ["x", "x__imputed"]
    assert approximate.filter("x__imputed is null").isEmpty()


def test_standard_scores_use_the_sample_deviation(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, same double")
    rows = standardize(frame, ["x", "same"]).collect()
    assert sorted(round(row["x"], 4) for row in rows) == [-0.8729, -0.2182, 1.0911]
    assert [row["same"] for row in rows] == [0.0, 0.0, 0.0]


def test_preparation_fills_scales_and_keeps_one_row_per_key(spark):
    rows = [
        ("k1", "One", "Soup", "55", "8", "1", "30", "2", "0,5", "4", "0,3"),
        ("k2", None, "Soup", "410", "61", "9,5", "12", "3", "7", "18", "2"),
        ("k3", " Three", None, "128", "17", "3", "77", "41", "2", "9", None),
        ("k3", "Three", "Soup", "700", "70", "7", "7", "7", "7", "7", "7"),
    ]
    raw = spark.createDataFrame(rows, TABLE_LAYOUT.raw_schema)
    prepared = prepare_products(raw)
    assert prepared.schema.names == PREPARED_SCHEMA.names
    found = {row["code"]: row for row in prepared.collect()}
    assert set(found) == {"k1", "k2", "k3"}
    assert found["k2"]["product_name"] == ""
    # The survivor of k3 is the smaller text, which starts with a blank.
    assert found["k3"]["product_name"] == " Three"
    assert found["k3"]["categories"] == ""
    assert all(math.isfinite(row[name]) for row in found.values() for name in FEATURE_SLOTS)
    # Its missing salt is filled with the lower median of 0.3 and 2.
    assert found["k3"]["f7"] == found["k1"]["f7"]
    for name in FEATURE_SLOTS:
        values = [row[name] for row in found.values()]
        assert sum(values) == pytest.approx(0.0)
        assert sum(x * x for x in values) == pytest.approx(len(values) - 1)


def test_nothing_to_prepare_is_an_error(spark):
    with pytest.raises(ValueError, match="contains no products"):
        prepare_products(spark.createDataFrame([], TABLE_LAYOUT.raw_schema))
    unusable = spark.createDataFrame([("1", *["x"] * 10)], TABLE_LAYOUT.raw_schema)
    with pytest.raises(ValueError, match="contains no products"):
        prepare_products(unusable)
    partial = spark.createDataFrame([("1", "", "", "5", *["x"] * 7)], TABLE_LAYOUT.raw_schema)
    with pytest.raises(ValueError, match="no values to take a median of in: fat_100g"):
        prepare_products(partial)


def test_vectors_round_trip_and_refuse_nulls(spark):
    frame = spark.createDataFrame([("a", 1.0, 2.0)], "code string, f0 double, f1 double")
    vectors = assemble(frame, ["f0", "f1"]).select("code", "features")
    assert [tuple(r) for r in spread(vectors, names=["f0", "f1"]).collect()] == [("a", 1.0, 2.0)]
    holed = spark.createDataFrame([("a", None, 2.0)], "code string, f0 double, f1 double")
    with pytest.raises(Exception, match="null"):
        assemble(holed, ["f0", "f1"]).collect()
