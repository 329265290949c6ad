from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.operators import explain, features, models, selection, split


def marked(df):
    rows = split.with_fold(split.with_split(df, ["row_id"]), ["row_id"], 3)
    return rows.withColumn("held_out", F.col("split") == "test")


def forest():
    return models.random_forest(trees=15, depth=5)


@pytest.fixture(scope="module")
def parts(planted):
    return models.prepare(marked(planted), "held_out")


@pytest.fixture(scope="module")
def fitted(parts):
    return {
        name: models.fit_classifier(estimator, parts.train, parts.features, parts.slicer)
        for name, estimator in {
            "forest": forest(),
            "regression": models.logistic_regression(penalty=0.01),
        }.items()
    }


def test_both_models_learn_a_planted_rule(parts, fitted):
    for model in fitted.values():
        row = models.accuracy(model, parts.test).first()
        assert row.accuracy > 0.7
        assert row.n_skipped == 0
    test = parts.test.agg(F.sum("n")).first()[0]
    assert row.n_scored == test


def test_settings_of_the_fitted_forest(fitted):
    model = fitted["forest"].classifier
    assert model.getNumTrees == 15
    assert model.getMaxDepth() == 5
    assert model.numClasses == 4


def test_importance_is_named_and_sums_to_one(planted, fitted):
    table = explain.feature_importance(fitted["forest"], planted)
    rows = table.collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert sum(r.selected for r in rows) == 10
    assert all(r.importance == 0 for r in rows if not r.selected)
    by_column = {
        r.source_column: r.importance
        for r in explain.source_importance(table, fitted["forest"]).collect()
    }
    assert list(by_column) and set(by_column) == {
        "gender", "is_member", "province", "age", "unit_price",
    }
    assert by_column["gender"] + by_column["age"] > 0.9


def test_column_without_a_slot_has_importance_zero(planted):
    one_gender = marked(planted.withColumn("gender", F.lit("female")))
    parts = models.prepare(one_gender, "held_out")
    model = models.fit_classifier(forest(), parts.train, parts.features, parts.slicer)
    table = explain.source_importance(explain.feature_importance(model, planted), model)
    assert {r.source_column: r.importance for r in table.collect()}["gender"] == 0.0


def test_coefficients_are_named(planted, fitted):
    rows = explain.coefficients(fitted["regression"], planted).collect()
    assert len(rows) == 4 * 10
    assert {r.category for r in rows} == {"books", "food", "sport", "toys"}
    female = {r.category: r.coefficient for r in rows if r.feature == "gender=female"}
    assert min(female["books"], female["food"]) > max(female["sport"], female["toys"])


@pytest.mark.parametrize("ranking", ["p_value", "log_p"])
def test_regression_on_cells_equals_regression_on_rows(planted, ranking):
    model = features.fit_features(planted)
    cells = features.cells(planted, model)
    slicer = selection.select_slots(cells, model, ranking=ranking)
    on_cells = models.fit_classifier(models.logistic_regression(), cells, model, slicer).classifier
    rows = slicer.transform(model.transform(planted)).join(
        spark_labels(planted, model), "category"
    )
    on_rows = LogisticRegression(
        featuresCol="selectedFeatures", labelCol="label", maxIter=100, regParam=0.1
    ).fit(rows)
    assert on_cells.coefficientMatrix.toArray() == pytest.approx(
        on_rows.coefficientMatrix.toArray(), abs=1e-4
    )
    assert on_cells.interceptVector.toArray() == pytest.approx(
        on_rows.interceptVector.toArray(), abs=1e-4
    )


def spark_labels(df, model):
    return df.sparkSession.createDataFrame(
        [(name, float(i)) for i, name in enumerate(model.labels)], "category string, label double"
    )


def test_merged_cells_show_the_model_the_same(parts):
    merged = models.merge_cells(parts.train, parts.features, parts.slicer)
    assert merged.count() < parts.train.count()

    def counts(cells):
        seen = parts.slicer.transform(parts.features.vectors(cells))
        table = seen.groupBy(
            vector_to_array("selectedFeatures").cast("string").alias("v"), "label"
        ).agg(F.sum("n").alias("n"))
        return {(r.v, r.label): r.n for r in table.collect()}

    assert counts(merged) == counts(parts.train)
    assert merged.count() == len(counts(merged))


@pytest.mark.parametrize("units", [1, 7, 1000])
def test_training_units_keep_every_purchase(parts, units):
    spread = models.training_units(parts.train, units)
    assert spread.agg(F.sum("weight")).first()[0] == pytest.approx(
        parts.train.agg(F.sum("n")).first()[0]
    )
    keys = [c for c in parts.train.columns if c != "n"]
    most = spread.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert most <= units
    if units == 1000:
        assert spread.where("weight != 1").isEmpty()


def test_forest_does_not_depend_on_partitions(planted):
    def trees(df):
        parts = models.prepare(marked(df), "held_out", features.FeatureSpec(relative_error=0.0))
        model = models.fit_classifier(forest(), parts.train, parts.features, parts.slicer)
        return [t.toDebugString.split("\n", 1)[1] for t in model.classifier.trees]

    assert trees(planted.repartition(2)) == trees(planted.repartition(7))


def test_confusion_and_class_report_agree_with_the_stock_evaluator(planted, parts, fitted):
    model = fitted["forest"]
    matrix = models.confusion(model, parts.test)
    total = matrix.agg(F.sum("n")).first()[0]
    right = matrix.where("category = predicted").agg(F.sum("n")).first()[0]
    assert right / total == pytest.approx(models.accuracy(model, parts.test).first().accuracy)

    rows = model.pipeline().transform(marked(planted).where("held_out"))
    rows = rows.join(spark_labels(planted, model.features), "category")
    stock = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(rows)
    assert right / total == pytest.approx(stock)

    report = {r.category: r for r in models.class_report(matrix).collect()}
    by_label = MulticlassClassificationEvaluator(
        metricName="recallByLabel", metricLabel=1.0
    ).evaluate(rows)
    assert report[model.features.labels[1]].recall == pytest.approx(by_label)


def test_forest_takes_more_bins_than_its_default(planted):
    spec = features.FeatureSpec(bins={"age": 40}, categorical=("gender",))
    parts = models.prepare(marked(planted), "held_out", spec)
    model = models.fit_classifier(forest(), parts.train, parts.features, parts.slicer, units=50)
    assert len(parts.features.bucketizer.getSplitsArray()[0]) - 1 > 32
    assert models.accuracy(model, parts.test).first().accuracy > 0.7


def test_predictions_are_categories(planted, fitted):
    out = fitted["forest"].predict(planted)
    assert out.columns == [*planted.columns, "predicted_category"]
    hits = out.where("category = predicted_category").count() / planted.count()
    assert hits > 0.7


def test_label_not_met_in_training_is_skipped_and_counted(planted):
    rows = marked(planted)
    first = rows.where("held_out").select("row_id").orderBy("row_id").first()[0]
    odd = rows.withColumn(
        "category", F.when(F.col("row_id") == first, "new").otherwise(F.col("category"))
    )
    parts = models.prepare(odd, "held_out")
    model = models.fit_classifier(
        models.logistic_regression(), parts.train, parts.features, parts.slicer
    )
    row = models.accuracy(model, parts.test).first()
    assert row.n_skipped == 1
    assert models.confusion(model, parts.test).agg(F.sum("n")).first()[0] == row.n_scored


def test_scores_do_not_depend_on_parallel_folds(planted):
    train = marked(planted).where("NOT held_out")
    candidates = {"regression": (models.logistic_regression(iterations=5), [])}
    one = models.cross_validate(train, candidates, parallelism=1).collect()
    assert sorted(one) == sorted(models.cross_validate(train, candidates, parallelism=3).collect())
    assert [r.fold for r in sorted(one)] == [0, 1, 2]


def test_cross_validation_and_leaderboard(planted):
    rows = marked(planted)
    estimator, grid = models.forest_grid(trees=(5,), depths=(1, 5))
    candidates = {
        "forest": (estimator, grid),
        "regression": (models.logistic_regression(), []),
    }
    scores = models.cross_validate(rows.where("NOT held_out"), candidates, parallelism=3)
    got = scores.collect()
    assert len(got) == 3 * (2 + 1)
    assert all(0 <= r.accuracy <= 1 for r in got)
    assert {r.params for r in got if r.model == "forest"} == {
        "maxDepth=1, numTrees=5", "maxDepth=5, numTrees=5",
    }

    board, fitted = models.leaderboard(rows, candidates, parallelism=3)
    table = {r.model: r for r in board.collect()}
    assert table["forest"].params == "maxDepth=5, numTrees=5"
    assert fitted["forest"].classifier.getMaxDepth() == 5
    best = max(table.values(), key=lambda r: r.cv_accuracy)
    assert [r.model for r in table.values() if r.is_best] == [best.model]
    assert best.cv_accuracy > 0.7 and best.test_accuracy > 0.7


def test_class_report_has_every_known_category(spark):
    matrix = spark.createDataFrame(
        [("a", "a", 3), ("a", "c", 1), ("b", "a", 2)], "category string, predicted string, n bigint"
    )
    rows = {r.category: (r.n, r.recall, r.precision) for r in
            models.class_report(matrix, ["a", "b", "c", "d"]).collect()}
    assert rows == {
        "a": (4, 0.75, 0.6), "b": (2, 0.0, None), "c": (0, None, 0.0), "d": (0, None, None),
    }


def test_training_on_nothing_says_so(planted):
    rows = planted.limit(0).withColumn("held_out", F.lit(False))
    parts = models.prepare(rows, "held_out")
    with pytest.raises(ValueError, match="training purchases|to train on"):
        models.fit_classifier(
            models.logistic_regression(), parts.train, parts.features, parts.slicer
        )


def test_default_ranking_lets_models_learn_from_large_tables(planted):
    """Counts as of a table 1000 times as large, where all p-values are 0."""
    parts = models.prepare(marked(planted), "held_out")
    train, test = (c.withColumn("n", F.col("n") * 1000) for c in (parts.train, parts.test))
    slicer = models.select_slots(train, parts.features, 3)
    fitted = models.fit_classifier(forest(), train, parts.features, slicer)
    assert models.accuracy(fitted, test).first().accuracy > 0.7


def test_folds_share_the_passes_over_the_purchases(planted, monkeypatch):
    """Value lists and sketches are taken once, however many folds there are."""
    calls = []
    taken = models.fit_feature_models
    monkeypatch.setattr(
        models, "fit_feature_models", lambda df, parts, spec: calls.append(len(parts)) or taken(df, parts, spec)
    )
    candidates = {"regression": (models.logistic_regression(iterations=2), [])}
    models.leaderboard(marked(planted), candidates)
    assert calls == [4]


def test_halving_finds_the_winner_of_the_grid_at_less_than_half_the_cost(planted):
    df = split.with_fold(planted, ["row_id"], 9)
    grid = models.forest_grid((3,), (1, 2, 3, 5))
    lines = models.halving(df, {"forest": grid}, rungs=4, parallelism=2).collect()
    full = 4
    assert sum(r.share for r in lines) < full / 2
    assert [sum(r.rung == i for r in lines) for i in range(3)] == [4, 2, 1]
    (best,) = [r for r in lines if r.is_best]
    marked = df.withColumn("held_out", F.col("fold") == 0)
    parts = models.prepare(marked, "held_out")
    scores = [
        models.accuracy(
            models.fit_classifier(grid[0].copy(p), parts.train, parts.features, parts.slicer), parts.test
        ).first().accuracy
        for p in grid[1]
    ]
    assert scores[best.point] == max(scores)


def test_partitions_reach_every_fit(planted, monkeypatch):
    seen = []
    plain = models.fit_classifier

    def noted(*args, **options):
        seen.append(args[5])
        return plain(*args, **options)

    monkeypatch.setattr(models, "fit_classifier", noted)
    marked = split.with_fold(planted, ["row_id"], 2).withColumn("held_out", F.col("age") > 60)
    models.leaderboard(marked, {"lr": (models.logistic_regression(3), [])}, folds=2, partitions=3)
    assert seen == [3, 3, 3]
