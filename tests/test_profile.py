from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from basketlens.operators import crosstab, profile

from .conftest import SCHEMA


def test_basic_stats_are_numbers(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 5.0), (None, 8.0)], "a int, b double")
    rows = {r["column"]: r for r in profile.basic_stats(df, ["a", "b"]).collect()}
    assert rows["a"][1:3] + rows["a"][4:] == (2, 2.0, 1.0, 3.0)
    assert rows["b"].stddev == pytest.approx(statistics.stdev([2, 5, 8]))


def test_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    assert profile.value_share(df, "g", "a").first()[:] == (2, 3, 66.67)
    assert profile.value_share(df, "g", "none").first().share == 0.0
    assert profile.value_share(df.limit(0), "g", "a").first().share == 0.0


def test_ties_go_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "ccbbaad"], "g string")
    assert [r.g for r in profile.top_groups(df, "g", 2).collect()] == ["a", "b"]
    rows = {r["rank"]: r for r in profile.best_and_worst(df, "g").collect()}
    assert (rows["best"].g, rows["best"].n) == ("a", 2)
    assert (rows["worst"].g, rows["worst"].n) == ("d", 1)
    assert rows["worst"].share == 14.29


def test_bands_match_their_labels(spark):
    ages = [24, 25, 34, 35, 44, 45, -3, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    banded = [r.age_band for r in crosstab.with_age_band(df).collect()]
    first, second, third, last = "[0,25)", "[25,35)", "[35,45)", "[45,inf)"
    assert banded == [first, second, second, third, third, last, first, last, None]
    top = profile.top_age_band(df).first()
    assert (top.age_band, top.n) == (first, 2)
    with pytest.raises(ValueError):
        crosstab.with_age_band(df, (30, 20))


def test_sparse_pivot_has_zeros(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "g string, c string")
    rows = {r.g: (r.x, r.y) for r in crosstab.pivot_counts(df, "g", "c").collect()}
    assert rows == {"A": (1, 1), "B": (1, 0)}
    given = crosstab.pivot_counts(df, "g", "c", ["y", "z"]).collect()
    assert {r.g: (r.y, r.z) for r in given} == {"A": (1, 0), "B": (0, 0)}
    with pytest.raises(ValueError, match="long form"):
        crosstab.pivot_counts(df, "g", "c", max_values=1)


def test_pivot_takes_any_value_names(spark):
    names = ["A.B", "b`c", "row", "value", "x y"]
    df = spark.createDataFrame([("g1", n) for n in names] + [("g2", "A.B")], "g string, `c.d` string")
    rows = {r[0]: tuple(r)[1:] for r in crosstab.pivot_counts(df, "g", "c.d").collect()}
    assert rows == {"g1": (1, 1, 1, 1, 1), "g2": (1, 0, 0, 0, 0)}
    with pytest.raises(ValueError, match="like the row column"):
        crosstab.pivot_counts(spark.createDataFrame([("a", "g")], "g string, c string"), "g", "c")


def test_pivot_rows_add_up_to_group_counts(planted):
    wide = crosstab.pivot_counts(planted, "gender", "category")
    names = [c for c in wide.columns if c != "gender"]
    sums = {r.gender: sum(r[c] for c in names) for r in wide.collect()}
    assert sums == {r.gender: r.n for r in profile.group_counts(planted, "gender").collect()}
    long = crosstab.cross_counts(planted, "gender", "category")
    assert long.agg(F.sum("n")).first()[0] == planted.count()


def test_member_averages(spark):
    df = spark.createDataFrame(
        [("yes", 1.0, 20), ("yes", 2.0, 30), ("no", 5.0, 40)],
        "is_member string, unit_price double, age int",
    )
    rows = {tuple(r) for r in profile.member_averages(df).collect()}
    assert rows == {("yes", 1.5, 25.0), ("no", 5.0, 40.0)}


def test_empty_frames(spark):
    df = spark.createDataFrame([], SCHEMA)
    for table in (
        profile.group_counts(df, "gender"),
        profile.top_groups(df, "province"),
        profile.best_and_worst(df, "category"),
        profile.top_age_band(df),
        profile.member_averages(df),
        crosstab.pivot_counts(df, "gender", "category"),
    ):
        assert table.count() == 0
    assert profile.distinct_count(df, "province").first()[0] == 0


def test_distinct_counts(planted):
    exact = profile.distinct_count(planted, "province").first()[0]
    assert exact == 10
    assert profile.distinct_count(planted, "province", approximate=True).first()[0] == exact


def test_top_groups_do_not_sort_everything(planted):
    plan = profile.top_groups(planted, "province")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
