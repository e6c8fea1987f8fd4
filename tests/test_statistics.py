from __future__ import annotations

import math
import random
import statistics

import pytest

from larder.operators.statistics import ColumnSummary, lower_medians, summarise


def lower(values):
    return sorted(values)[(len(values) - 1) // 2]


def shapes():
    rng = random.Random(7)
    yield "even", [1.0, 2.0, 3.0, 4.0]
    yield "single", [5.0]
    yield "constant", [2.5] * 50
    yield "hot value", [3.0] * 400 + [rng.uniform(0, 100) for _ in range(800)]
    yield "distinct", [rng.random() for _ in range(3001)]
    yield "wide range", [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9) for _ in range(999)]
    yield "clustered", [1.0 + k * 2**-52 for k in range(500)] + [1e9]
    yield "negative", [-float(k) for k in range(100)]
    yield "tiny", [5e-324 * k for k in range(40)]


@pytest.mark.parametrize("name,values", list(shapes()))
def test_median_is_the_exact_lower_median(spark, name, values):
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame(
        [(v, -v) for v in values] + [(None, None), (math.nan, math.nan)], "x double, y double"
    )
    assert lower_medians(frame, ["x", "y"]) == {
        "x": lower(values), "y": lower([-v for v in values])
    }


def test_columns_of_different_length_and_odd_names(spark):
    frame = spark.createDataFrame(
        [(1.0, None), (2.0, 7.0), (9.0, None)], "`a-b` double, c double"
    )
    assert lower_medians(frame, ["a-b", "c"]) == {"a-b": 2.0, "c": 7.0}


def test_a_column_without_values_is_an_error(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, math.nan)], "a double, b double")
    with pytest.raises(ValueError, match="no values to take a median of in: b"):
        lower_medians(frame, ["a", "b"])


def test_an_endless_range_is_an_error(spark):
    frame = spark.createDataFrame([(1.0,), (math.inf,)], "a double")
    with pytest.raises(ValueError, match="finite value range in: a"):
        lower_medians(frame, ["a"])


def test_summary_and_filling_agree_with_direct_moments(spark):
    values = [1.0, 2.0, 4.0, 4.5]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "x double")
    summary = summarise(frame, ["x"])["x"]
    assert (summary.rows, summary.present, summary.median) == (7, 4, None)
    filled = values + [2.0] * 3
    mean, deviation = summary.filled_with(2.0)
    assert mean == pytest.approx(statistics.mean(filled))
    assert deviation == pytest.approx(statistics.stdev(filled))


def test_filling_a_single_row():
    assert ColumnSummary(1, 1, 3.0, 0.0).filled_with(3.0) == (3.0, 0.0)
