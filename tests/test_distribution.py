from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.operators import distribution


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-1000, 1000), min_size=2, max_size=60))
def test_histogram_agrees_with_numpy(spark, values):
    rows = distribution.histogram(frame(spark, map(float, values)), "x").orderBy("bin").collect()
    if min(values) == max(values):
        assert [(r.bin, r.n) for r in rows] == [(0, len(values))]
        return
    assert sum(r.n for r in rows) == len(values)
    assert [r.bin for r in rows] == list(range(20))
    expected, edges = np.histogram(values, bins=20)
    assert [r.lower for r in rows] == pytest.approx(edges[:-1].tolist(), abs=1e-9)
    # A value on a bin edge may round to either side.
    on_edge = sum(min(abs(v - e) for e in edges[1:-1]) < 1e-9 for v in values)
    assert sum(abs(r.n - n) for r, n in zip(rows, expected)) <= 2 * on_edge


def test_constant_column_and_empty_frame(spark):
    constant = frame(spark, [30.0] * 5)
    assert [r.n for r in distribution.histogram(constant, "x").collect()] == [5]
    assert distribution.density(constant, "x").count() == 0
    empty = frame(spark, [])
    assert distribution.histogram(empty, "x").count() == 0
    assert distribution.density(empty, "x").count() == 0


def test_density_is_the_kernel_sum(spark):
    values = [1.0, 2.0, 2.0, 3.0, 7.0, 9.5]
    rows = distribution.density(frame(spark, values), "x").orderBy("point").collect()
    x = np.array(values)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(1.0, 9.5, 200)
    z = (grid[:, None] - x[None, :]) / h
    expected = np.exp(-z * z / 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert [r.x for r in rows] == pytest.approx(grid.tolist())
    assert [r.density for r in rows] == pytest.approx(expected.tolist(), rel=1e-9)
    step = (9.5 - 1.0) / 199
    mass = sum(r.density for r in rows) * step
    assert 0.5 < mass <= 1 + 1e-9
    assert rows[5].curve == pytest.approx(rows[5].density * 6 * 8.5 / 20)


def test_density_with_rounded_values_is_close(spark):
    df = spark.range(2000).select((F.sqrt("id")).alias("x"))
    exact = [r.density for r in distribution.density(df, "x").orderBy("point").collect()]
    near = distribution.density(df, "x", resolution=0.05).orderBy("point").collect()
    assert [r.density for r in near] == pytest.approx(exact, rel=1e-2)


def test_binned_density_is_close_to_the_sum_over_all_values(spark):
    source = random.Random(4)
    rows = [(source.gauss(50, 4) if i % 3 else source.uniform(0, 100),) for i in range(4000)] + [(None,), (49.0,)]
    df = spark.createDataFrame(rows, "x double").repartition(4)
    direct = {r.point: r for r in distribution.density(df, "x").collect()}
    binned = {r.point: r for r in distribution.binned_density(df, "x").collect()}
    assert set(direct) == set(binned)
    peak = max(r.density for r in direct.values())
    for point, r in binned.items():
        assert abs(r.x - direct[point].x) < 1e-9
        assert abs(r.density - direct[point].density) < peak / 128
        assert abs(r.curve / r.density - direct[point].curve / direct[point].density) < 1e-6
    finer = {r.point: r for r in distribution.binned_density(df, "x", fineness=40, cutoff=9.0).collect()}
    assert max(abs(r.density - direct[p].density) for p, r in finer.items()) < peak / 10_000


def test_binned_density_reaches_only_near_points(spark):
    far = spark.createDataFrame([(0.0,)] * 5000 + [(1.0,)] * 5000 + [(1000.0,)], "x double")
    curve = {r.point: r.density for r in distribution.binned_density(far, "x").collect()}
    assert len(curve) == 200 and curve[0] > 0 and curve[100] == 0.0


def test_binned_density_without_spread(spark):
    assert distribution.binned_density(spark.createDataFrame([(3.0,)] * 5, "x double"), "x").count() == 0
    assert distribution.binned_density(spark.createDataFrame([], "x double"), "x").count() == 0
