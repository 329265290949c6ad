from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketlens.operators import quantiles


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def brute(values, groups):
    ordered = sorted(values)
    return [ordered[math.ceil(i * len(ordered) / groups) - 1] for i in range(1, groups)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80), st.integers(2, 6))
def test_exact_quantiles_by_brute_force(spark, values, groups):
    df = frame(spark, values)
    assert quantiles.exact_quantiles(df, "x", groups) == brute(values, groups)


@pytest.mark.parametrize("limit", [20, 400, 10_000])
def test_slices_are_cut_again_when_they_hold_too_many_values(spark, limit):
    values = [math.sin(i) * 1000 for i in range(3000)]
    got = quantiles.exact_quantiles(frame(spark, values), "x", 3, max_values=limit, slices=10)
    assert got == brute(values, 3)


@pytest.mark.parametrize("hot", [-1.0, 500.0])
def test_hot_value_with_a_third_of_the_rows(spark, hot):
    values = [float(i) for i in range(1000)] + [hot] * 500
    got = quantiles.exact_quantiles(frame(spark, values), "x", 4, max_values=20, slices=8)
    assert got == brute(values, 4)


def test_many_values_beside_an_overwhelming_one(spark):
    values = [i / 1000 for i in range(200)] + [5.0] * 20_000
    got = quantiles.exact_quantiles(frame(spark, values), "x", 200, max_values=8, slices=5)
    assert got == brute(values, 200)


def test_null_nan_infinite_and_nothing(spark):
    df = spark.createDataFrame(
        [(1.0,), (None,), (math.nan,), (math.inf,), (-math.inf,), (2.0,)], "x double"
    )
    assert quantiles.exact_quantiles(df, "x", 4) == [-math.inf, 1.0, 2.0]
    assert quantiles.exact_quantiles(df.limit(0), "x", 4) == []
    assert quantiles.bin_counts(df.limit(0), "x", 4).count() == 0


@pytest.mark.parametrize("error", [0.0, 0.0001])
def test_equal_cut_points_merge(spark, error):
    df = frame(spark, [1] * 6 + [2, 3, 4, 5])
    bins = quantiles.fit_bins(df, {"x": 4}, ["b"], error)
    assert bins.getSplitsArray() == [[-math.inf, 1.0, 3.0, math.inf]]


def test_one_to_a_hundred(spark):
    rows = quantiles.bin_counts(frame(spark, range(1, 101)), "x", 4).orderBy("bin").collect()
    assert [(r.lower_cut, r.n) for r in rows] == [(None, 24), (25.0, 25), (50.0, 25), (75.0, 26)]


def test_bins_rise_with_the_value(planted):
    bins = quantiles.fit_bins(planted, {"unit_price": 5}, ["b"], 0.001)
    rows = bins.transform(planted).select("unit_price", "b").collect()
    numbers = [r.b for r in sorted(rows)]
    assert numbers == sorted(numbers) and set(numbers) == {0.0, 1.0, 2.0, 3.0, 4.0}
