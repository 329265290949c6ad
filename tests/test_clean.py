from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from basketlens.operators import clean
from basketlens.schema import CHINESE_COLUMNS, PurchaseColumns

TEXT = "gender string, age string, is_member string, category string, province string, "


def raw(spark, rows):
    return spark.createDataFrame(rows, TEXT + "unit_price string")


def test_bad_cells_are_rejected_not_raised(spark):
    ages = ["23", "abc", None, "23.7", "1e400", " 7 "]
    df = raw(spark, [("f", a, "y", "c", "p", "1.5") for a in ages])
    assert [r.age for r in clean.parse(df).collect()] == [23, None, None, 23, None, 7]
    assert [r.age for r in clean.clean(df).collect()] == [23, 23, 7]
    counts = clean.clean_counts(df).first()
    assert (counts.rows_in, counts.rows_kept) == (6, 3)
    assert (counts.missing_age, counts.invalid_age) == (1, 2)


def test_null_and_nan_drop_but_empty_text_stays(spark):
    schema = TEXT.replace("age string", "age int") + "unit_price double"
    rows = [
        ("a", 1, "y", "c", "p", 1.0),
        ("b", 1, "y", "c", "p", math.nan),
        ("c", 1, "y", "c", "p", None),
        ("", 1, "y", "c", "p", 2.0),
        (None, 1, "y", "c", "p", 3.0),
    ]
    df = spark.createDataFrame(rows, schema)
    kept = {(r.gender, r.unit_price) for r in clean.clean(df).collect()}
    assert kept == {("a", 1.0), ("", 2.0)}
    assert kept == {
        (r.gender, r.unit_price) for r in df.na.drop(subset=df.columns).collect()
    }
    counts = clean.clean_counts(df).first()
    assert (counts.missing_gender, counts.missing_unit_price) == (1, 1)
    assert counts.invalid_unit_price == 1


def test_double_price_does_not_drift(spark):
    df = raw(spark, [("f", "1", "y", "c", "p", x) for x in ("1.1", "2.2", "3.3")])
    exact = clean.clean(df).agg(F.avg("unit_price")).first()[0]
    assert abs(exact - 2.2) < 1e-12
    short = clean.clean(df, price_type="float").agg(F.avg("unit_price")).first()[0]
    assert short == pytest.approx(2.200000007947286)


def test_columns_are_found_by_the_given_names(spark):
    df = raw(spark, [("女", "30", "是", "书", "浙江", "9.5")]).toDF(
        *[source for _, source in CHINESE_COLUMNS.items()]
    )
    row = clean.clean(df, CHINESE_COLUMNS).first()
    assert row.asDict() == {
        "gender": "女", "age": 30, "is_member": "是", "category": "书", "province": "浙江",
        "unit_price": 9.5,
    }
    assert [ours for ours, _ in PurchaseColumns().items()] == list(row.asDict())


def test_null_checks_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(
        [("f", 1, "y", "c", "p", 1.0)], TEXT.replace("age string", "age int") + "unit_price double"
    ).write.parquet(path)
    plan = clean.clean(spark.read.parquet(path)).groupBy("gender").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text.split("PushedFilters: [")[1]
    for name in ("gender", "age", "is_member", "category", "province", "unit_price"):
        assert f"IsNotNull({name})" in pushed


def test_empty_table(spark):
    df = raw(spark, [])
    assert clean.clean(df).count() == 0
    assert clean.clean_counts(df).first().rows_in == 0


def test_one_pass_gives_rows_rejects_and_counts(spark):
    cells = [
        ("f", "23", "y", "c", "p", "1.5"), ("f", "abc", None, "c", "p", "x"), (None, None, "y", "c", "p", "NaN"),
        ("f", "7.9", "y", "c", "p", "2"), ("f", "23", "y", "c", None, None),
    ]
    passed = spark.sparkContext.accumulator(0)

    def met(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    df = raw(spark, cells)
    scanned = df.mapInArrow(met, df.schema)
    cleaned = clean.clean_and_land(scanned)
    assert sorted(cleaned.rows.collect()) == sorted(clean.clean(df).collect())
    assert cleaned.counts.collect() == clean.clean_counts(df).collect()
    assert cleaned.counts.schema == clean.clean_counts(df).schema or cleaned.counts.columns == clean.clean_counts(df).columns
    rejects = {tuple(r)[:6]: r.reasons for r in cleaned.rejects.collect()}
    assert rejects == {
        cells[1]: ["missing_is_member", "invalid_age", "invalid_unit_price"],
        cells[2]: ["missing_gender", "missing_age", "invalid_unit_price"],
        cells[4]: ["missing_province", "missing_unit_price"],
    }
    # Rows, rejects and counts have been read, and the source was met once.
    assert passed.value == len(cells)


def test_rejected_cells_keep_their_text_and_other_columns(spark):
    df = raw(spark, [("女", "x1", "是", "书", "浙江", "9.5")]).toDF(*[s for _, s in CHINESE_COLUMNS.items()])
    df = df.withColumn("order_id", F.lit(7)).withColumn("rejected", F.lit("clash"))
    cleaned = clean.clean_and_land(df, CHINESE_COLUMNS, keep=("order_id",))
    (row,) = cleaned.rejects.collect()
    assert (row.order_id, row.gender, row.age, row.unit_price, row.reasons) == (7, "女", "x1", "9.5", ["invalid_age"])
    assert cleaned.rows.count() == 0 and cleaned.rows.columns[0] == "order_id"


def test_one_pass_over_an_empty_table(spark):
    cleaned = clean.clean_and_land(raw(spark, []))
    assert cleaned.rows.count() == cleaned.rejects.count() == 0
    assert cleaned.counts.first().rows_in == 0
