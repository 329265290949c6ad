from __future__ import annotations

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, QuantileDiscretizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.operators import features, models, selection

from .conftest import SCHEMA

ERROR = features.FeatureSpec(unseen="error", relative_error=0.0)


def stock_stages(handle):
    names = ["gender", "is_member", "province"]
    return [
        StringIndexer(
            inputCols=names, outputCols=[f"{n}_index" for n in names], handleInvalid=handle
        ),
        QuantileDiscretizer(
            inputCols=["age", "unit_price"],
            outputCols=["age_bin", "unit_price_bin"],
            numBucketsArray=[4, 5],
            relativeError=0.0,
        ),
        OneHotEncoder(
            inputCols=[f"{n}_index" for n in names], outputCols=[f"{n}_vec" for n in names]
        ),
        VectorAssembler(
            inputCols=[f"{n}_vec" for n in names] + ["age_bin", "unit_price_bin"],
            outputCol="features",
        ),
    ]


@pytest.mark.parametrize("unseen", ["error", "keep"])
def test_vectors_equal_those_of_stock_stages(planted, unseen):
    spec = features.FeatureSpec(unseen=unseen, relative_error=0.0)
    ours = features.fit_features(planted, spec).transform(planted)
    stock = Pipeline(stages=stock_stages(unseen)).fit(planted).transform(planted)

    def vectors(df):
        table = df.select("row_id", vector_to_array("features").alias("v"))
        return {r.row_id: r.v for r in table.collect()}

    assert vectors(ours) == vectors(stock)


def test_layout_without_a_slot_for_the_rarest_value(planted):
    model = features.fit_features(planted, ERROR)
    provinces = planted.select("province").distinct().count()
    names = [s.feature for s in model.slots]
    assert len(names) == 1 + 1 + (provinces - 1) + 2
    assert names[provinces + 1 :] == ["age", "unit_price"]
    ranked = features.value_index(planted, "province").orderBy("index").collect()
    assert names[2 : provinces + 1] == [f"province={r.province}" for r in ranked[:-1]]
    assert [s.number for s in model.slots] == list(range(len(names)))


def test_layout_with_a_slot_per_value(planted):
    model = features.fit_features(planted)
    names = [s.feature for s in model.slots]
    provinces = planted.select("province").distinct().count()
    assert len(names) == 2 + 2 + provinces + 2
    assert {"gender=female", "gender=male", "is_member=yes", "age", "unit_price"} <= set(names)


def test_numbers_equal_those_of_the_stock_indexer(planted):
    stock = StringIndexer(inputCol="province", outputCol="i").fit(planted).labels
    ours = features.value_index(planted, "province").orderBy("index").collect()
    assert [r.province for r in ours] == list(stock)


def test_ties_are_numbered_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "bbaac"], "g string")
    rows = features.value_index(df, "g").orderBy("index").collect()
    assert [(r.g, r["index"]) for r in rows] == [("a", 0), ("b", 1), ("c", 2)]


def test_any_number_of_values_is_numbered(spark):
    rows = spark.range(50_000).selectExpr("concat('v', id) AS g", "id % 7 AS k")
    df = rows.select("g", F.explode(F.sequence(F.lit(0), F.col("k").cast("int"))))
    got = features.value_index(df, "g").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(50_000))
    assert [(r.n, r.g) for r in got] == sorted(((r.n, r.g) for r in got), key=lambda x: (-x[0], x[1]))


def test_unseen_values(spark, planted):
    other = planted.limit(1).withColumn("province", F.lit("elsewhere"))
    kept = features.fit_features(planted)
    (row,) = kept.transform(other).collect()
    assert row.province_index == planted.select("province").distinct().count()
    assert row.province_vec.numNonzeros() == 0
    strict = features.fit_features(planted, ERROR)
    with pytest.raises(Exception, match="Unseen label"):
        strict.transform(other).collect()


def test_column_with_one_value_has_no_slot(planted):
    df = planted.withColumn("gender", F.lit("female"))
    model = features.fit_features(df, ERROR)
    assert all(s.source_column != "gender" for s in model.slots)
    assert features.cells(df, model).agg(F.sum("n")).first()[0] == df.count()


def test_rare_values_share_one_place_only_when_asked(planted):
    with pytest.raises(ValueError, match="province has over 4"):
        features.fit_features(planted, features.FeatureSpec(max_categories=4))
    model = features.fit_features(planted, features.FeatureSpec(max_categories=4, fold_rare=True))
    assert sum(s.source_column == "province" for s in model.slots) == 4
    counts = sorted((r["count"] for r in planted.groupBy("province").count().collect()), reverse=True)
    assert model.folded == {"province": sum(counts[4:])}
    # With one feature column the lists are too long to be brought over whole.
    only = features.FeatureSpec(categorical=("province",), max_categories=4, fold_rare=True)
    alone = features.fit_features(planted, only)
    assert alone.folded == model.folded
    assert [s.feature for s in alone.slots][:4] == [
        s.feature for s in model.slots if s.source_column == "province"
    ]
    for spec in (
        features.FeatureSpec(max_categories=4, unseen="error", fold_rare=True),
        features.FeatureSpec(max_categories=3, fold_rare=True),
    ):
        with pytest.raises(ValueError, match="has over"):
            features.fit_features(planted, spec)


def test_models_of_parts_equal_models_of_the_filtered_rows(planted):
    parts = {"young": F.col("age") < 40, "all": F.lit(True)}
    spec = features.FeatureSpec(relative_error=0.0)
    both = features.fit_feature_models(planted, parts, spec)
    for name, condition in parts.items():
        alone = features.fit_features(planted.where(condition), spec)
        assert both[name].labels == alone.labels and both[name].slots == alone.slots
        assert both[name].bucketizer.getSplitsArray() == alone.bucketizer.getSplitsArray()


@pytest.mark.parametrize("error", [0.0, 0.001])
def test_empty_frame_gives_a_model_without_values(spark, error):
    empty = spark.createDataFrame([], SCHEMA)
    model = features.fit_features(empty, features.FeatureSpec(relative_error=error))
    assert model.labels == []
    assert features.cells(empty, model).count() == 0


def test_cells_hold_every_purchase_and_keep_metadata(planted):
    model = features.fit_features(planted)
    table = features.cells(planted, model)
    assert table.agg(F.sum("n")).first()[0] == planted.count()
    keys = [c for c in table.columns if c != "n"]
    assert table.groupBy(*keys).count().where("count > 1").isEmpty()
    assert model.vectors(table).schema["features"].metadata == (
        model.transform(planted).schema["features"].metadata
    )


def test_long_form_equals_the_vectors(planted):
    model = features.fit_features(planted, ERROR)
    long = features.nonzero_entries(planted, model, "row_id")
    got = {(r.row_id, r.slot, r.value) for r in long.collect()}
    vectors = model.transform(planted).select("row_id", vector_to_array("features").alias("v"))
    expected = {
        (r.row_id, i, v) for r in vectors.collect() for i, v in enumerate(r.v) if v != 0
    }
    assert got == expected


def test_null_labels_have_no_number(spark):
    df = spark.createDataFrame([("1", "f", 1, "y", None, "p", 1.0)], SCHEMA)
    assert features.fit_features(df).labels == []
    assert features.value_index(df, "category").count() == 0


HASH = features.FeatureSpec(unseen="hash", relative_error=0.0)


def test_hash_mode_below_the_limit_gives_the_cells_of_the_exact_mode(planted):
    exact = features.FeatureSpec(relative_error=0.0)
    a, b = (features.fit_features(planted, spec) for spec in (exact, HASH))
    assert a.slots == b.slots and b.hashed == {} and b.folded == {}
    assert sorted(features.cells(planted, a).collect()) == sorted(features.cells(planted, b).collect())


def test_rare_values_share_slots_by_their_hash(planted):
    spec = features.FeatureSpec(unseen="hash", max_categories=7, hash_slots=3, relative_error=0.0)
    model = features.fit_features(planted, spec)
    counts = sorted(((-r["count"], r.province) for r in planted.groupBy("province").count().collect()))
    kept = [p for _, p in counts[:4]]
    names = [s.feature for s in model.slots if s.source_column == "province"]
    assert names == [f"province={v}" for v in [*kept, "#0", "#1", "#2"]]
    assert model.folded == {"province": -sum(n for n, _ in counts[4:])}
    place = {p: i for i, p in enumerate(kept)}
    for p in [p for _, p in counts[4:]] + ["never met"]:
        place[p] = 4 + int(hashlib.md5(p.encode()).hexdigest()[:8], 16) % 3
    new = planted.limit(2).withColumn("province", F.lit("never met"))
    vector = vector_to_array("province_vec").alias("v")
    for row in model.transform(planted.unionByName(new)).select("province", vector).collect():
        assert row.v.index(1.0) == place[row.province] and sum(row.v) == 1.0
    table = features.cells(planted, model)
    assert table.agg(F.sum("n")).first()[0] == planted.count()
    long = features.nonzero_entries(planted, model, "row_id").where("slot >= 4 AND slot < 11").count()
    assert long == planted.count()
    # A null has no slot.
    (row,) = model.transform(planted.limit(1).withColumn("province", F.lit(None).cast("string"))).collect()
    assert row.province_vec.numNonzeros() == 0


def test_a_million_values_fit_without_a_list_of_them(spark):
    rows = spark.range(1_000_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'f' ELSE 'm' END AS gender", "CAST(20 + id % 40 AS INT) AS age",
        "CASE WHEN id % 3 = 0 THEN 'yes' ELSE 'no' END AS is_member",
        "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS category",
        "CASE WHEN id % 10 < 4 THEN 'hot' ELSE concat('P', id) END AS province", "CAST(id % 100 AS DOUBLE) AS unit_price",
    )
    spec = features.FeatureSpec(unseen="hash", max_categories=200)
    with pytest.raises(ValueError, match="province has over 200"):
        features.fit_features(rows, features.FeatureSpec(max_categories=200))
    model = features.fit_features(rows, spec)
    own = [s.feature for s in model.slots if s.source_column == "province"]
    assert own[0] == "province=hot" and len(own) <= 200 and own[-1] == "province=#63"
    table = features.cells(rows, model)
    assert table.agg(F.sum("n")).first()[0] == 1_000_000
    fitted = models.fit_classifier(
        models.logistic_regression(iterations=5), table, model, selection.select_slots(table, model)
    )
    assert models.accuracy(fitted, table).first().accuracy > 0.99


def test_hash_mode_learns_folds_apart(planted):
    parts = {"young": F.col("age") < 40, "all": F.lit(True)}
    spec = features.FeatureSpec(unseen="hash", max_categories=7, hash_slots=3, relative_error=0.0)
    both = features.fit_feature_models(planted, parts, spec)
    for name, condition in parts.items():
        alone = features.fit_features(planted.where(condition), spec)
        assert both[name].slots == alone.slots and both[name].folded == alone.folded
    assert features.fit_features(planted.limit(0), spec).labels == []
    with pytest.raises(ValueError, match="hash_slots"):
        features.fit_features(planted, features.FeatureSpec(unseen="hash", hash_slots=10_000))
