from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from basketlens.operators import split


def test_split_does_not_depend_on_partitions(planted):
    def parts(df):
        return {r.row_id: r.split for r in split.with_split(df, ["row_id"]).collect()}

    first = parts(planted.repartition(2))
    assert first == parts(planted.repartition(8)) == parts(planted.coalesce(1))
    train = sum(v == "train" for v in first.values()) / len(first)
    assert 0.66 < train < 0.74
    assert first != {
        r.row_id: r.split for r in split.with_split(planted, ["row_id"], seed=1).collect()
    }


def test_parts_are_disjoint_and_whole(planted):
    for keys in (["row_id"], None):
        train, test = split.train_test_split(planted, keys)
        a = {r.row_id for r in train.select("row_id").collect()}
        b = {r.row_id for r in test.select("row_id").collect()}
        assert not a & b and len(a | b) == planted.count()


def test_three_parts(planted):
    marked = split.with_split(planted, ["row_id"], (2, 1, 1), names=("a", "b", "c"))
    counts = {r[0]: r[1] / planted.count() for r in marked.groupBy("split").count().collect()}
    assert abs(counts["a"] - 0.5) < 0.05 and abs(counts["c"] - 0.25) < 0.05


def test_folds_are_even_and_independent_of_the_split(planted):
    df = split.with_fold(split.with_split(planted, ["row_id"]), ["row_id"], 3)
    n = planted.count()
    for part, share in (("train", 0.7), ("test", 0.3)):
        for fold in range(3):
            got = df.where(f"split = '{part}' AND fold = {fold}").count() / n
            assert abs(got - share / 3) < 0.03


def by_hand(rows, weights, names, seed=42):
    """Parts by sorting each stratum; rows (key, stratum)."""
    out, total = {}, sum(weights)
    for stratum in {r[1] for r in rows}:
        keys = sorted((k for k, s in rows if s == stratum), key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest())
        ends = [int(len(keys) * sum(weights[: i + 1]) / total + 0.5) for i in range(len(weights))]
        for place, key in enumerate(keys):
            out[key] = names[next(i for i, e in enumerate(ends) if place < e)]
    return out


@pytest.mark.parametrize("weights,names", [((0.7, 0.3), ("train", "test")), ((2, 1, 1), ("a", "b", "c")), ((1,), ("all",))])
def test_every_stratum_is_cut_exactly(spark, weights, names):
    rows = [(f"k{i}", ("big", "mid", None, "small", "one")[min(4, i * i % 97 % 7)]) for i in range(3000)] + [("x", "lone")]
    df = spark.createDataFrame(rows, "key string, stratum string").repartition(5)
    got = split.with_stratified_split(df, ["key"], ["stratum"], weights, names=names)
    assert got.columns == ["key", "stratum", "split"]
    assert {r.key: r.split for r in got.collect()} == by_hand(rows, weights, names)


def test_cuts_are_found_in_later_digits(spark, monkeypatch):
    monkeypatch.setattr(split, "STEP", 1)
    rows = [(str(i), "a" if i % 3 else "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, stratum string")
    got = split.with_stratified_split(df, ["key"], ["stratum"])
    assert {r.key: r.split for r in got.collect()} == by_hand(rows, (0.7, 0.3), ("train", "test"))


def test_rows_of_one_key_stay_together_in_strata(spark):
    rows = [("same", "a")] * 60 + [(f"k{i}", "a") for i in range(40)] + [("only", "b")] * 9
    df = spark.createDataFrame(rows, "key string, stratum string")
    got = split.with_stratified_split(df, ["key"], ["stratum"])
    assert got.count() == len(rows)
    parts = got.groupBy("stratum", "key").agg(F.count_distinct("split").alias("n"))
    assert parts.where("n > 1").count() == 0
    # One key is all of b: the part that most of it belongs to takes it.
    assert got.where("stratum = 'b' AND split = 'train'").count() == 9


def test_strata_of_several_columns_and_empty_tables(spark):
    rows = [(i, i % 2, None if i % 3 else "x") for i in range(600)]
    df = spark.createDataFrame(rows, "key long, a int, b string")
    got = split.with_stratified_split(df, ["key"], ["a", "b"])
    lines = got.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect()
    assert len(lines) == 4 and all(r.t == int(r.n * 0.7 + 0.5) for r in lines)
    assert split.with_stratified_split(df.limit(0), ["key"], ["a"]).count() == 0


def test_no_task_sorts_a_stratum(spark):
    df = spark.range(5000).selectExpr("id AS key", "'one' AS stratum")
    plan = split.with_stratified_split(df, ["key"], ["stratum"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
