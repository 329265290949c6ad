"""Named analyses over the test tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators import (
    clean,
    crosstab,
    distribution,
    explain,
    features,
    models,
    profile,
    quantiles,
    ranking,
    running,
    selection,
    split,
)
from basketlens.plans import report
from basketlens.plans.purchases import KEY, dirty_purchases, purchases
from basketlens.schema import AGE_BINS, PRICE_BINS
from basketlens.sources.csv import read_mixed_purchases, read_purchases
from basketlens.sources.landing import land, new_path

Query = Callable[[SparkSession, str], DataFrame]

EXACT_LAYOUT = features.FeatureSpec(unseen="error", relative_error=0.0)
PARALLEL_FOLDS = 3


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases for analyses which do not show the key."""
    return purchases(spark, sf_dir, keyed=False)


def _marked(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    return purchases(spark, sf_dir, keyed=keyed).withColumn("held_out", F.col("split") == "test")


def _candidates() -> dict[str, tuple]:
    return {
        "random forest": models.forest_grid(),
        "logistic regression": (models.logistic_regression(), []),
    }


def _fit(
    spark: SparkSession, sf_dir: str, classifier, keyed: bool = False
) -> tuple[models.FittedModel, DataFrame]:
    parts = models.prepare(_marked(spark, sf_dir, keyed), "held_out")
    return models.fit_classifier(classifier, parts.train, parts.features, parts.slicer), parts.test


# Ingestion and cleaning


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the dirty purchases as CSV, read them back by header, clean them."""
    path = new_path(spark, "csv")
    dirty_purchases(spark, sf_dir).write.option("header", True).csv(path)
    return clean.clean(read_purchases(spark, path, keep=(KEY,)), keep=(KEY,))


def ingest_mixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files of two column orders in one folder, with a column more and broken lines."""
    path = new_path(spark, "csv")
    dirty = dirty_purchases(spark, sf_dir)
    first = F.col(KEY) < "8"
    dirty.where(first).write.option("header", True).csv(path)
    turned = dirty.select(F.lit("x").alias("note"), *reversed(dirty.columns))
    turned.where(~first).write.mode("append").option("header", True).csv(path)
    # A file with a line of too few cells for each category, of which there are a few.
    names = F.array_sort(F.collect_set("category"))
    lines = F.concat(F.array(F.lit(",".join(dirty.columns))), F.transform(names, lambda c: F.concat(c, F.lit(",7"))))
    dirty.agg(F.array_join(lines, "\n").alias("value")).coalesce(1).write.mode("append").text(path)
    return clean.clean(read_mixed_purchases(spark, path, keep=(KEY,)), keep=(KEY,))


def clean_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(dirty_purchases(spark, sf_dir), keep=(KEY,))


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_counts(dirty_purchases(spark, sf_dir))


def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of ``clean_counts``, taken while all rows are written."""
    return clean.clean_and_land(dirty_purchases(spark, sf_dir), keep=(KEY,)).counts


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected purchases with the cells that they came with, and why."""
    rejects = clean.clean_and_land(dirty_purchases(spark, sf_dir), keep=(KEY,)).rejects
    return rejects.select(KEY, "age", "is_member", F.array_join("reasons", ",").alias("reasons"))


# Description


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.group_counts(_rows(spark, sf_dir), "category")


def gender_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.group_counts(_rows(spark, sf_dir), "gender")


def basic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.basic_stats(_rows(spark, sf_dir), ["age", "unit_price"], digits=4)


def member_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.member_averages(_rows(spark, sf_dir), digits=4)


def top_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_groups(_rows(spark, sf_dir), "province")


def province_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_count(_rows(spark, sf_dir), "province")


def gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_share(_rows(spark, sf_dir), "gender", "female")


def member_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_share(_rows(spark, sf_dir), "is_member", "yes")


def best_worst_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.best_and_worst(_rows(spark, sf_dir), "category")


def age_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.age_band_counts(_rows(spark, sf_dir))


def top_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_age_band(_rows(spark, sf_dir))


def gender_category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstab.pivot_counts(_rows(spark, sf_dir), "gender", "category")


def gender_category_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstab.cross_counts(_rows(spark, sf_dir), "gender", "category")


def age_band_category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = crosstab.with_age_band(_rows(spark, sf_dir))
    return crosstab.pivot_counts(banded, "age_band", "category")


def age_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(distribution.histogram(_rows(spark, sf_dir), "age"), 6, "lower", "upper")


def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = distribution.histogram(_rows(spark, sf_dir), "unit_price")
    return _rounded(table, 6, "lower", "upper")


def age_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(distribution.density(_rows(spark, sf_dir), "age"), 9, "x", "density",
                    "curve", curve=4)


def price_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(distribution.binned_density(_rows(spark, sf_dir), "unit_price"), 9, "density", x=6, curve=4)


def _growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a state that took the purchases in two batches of files."""
    folder, state = new_path(spark, "growing"), new_path(spark, "state")
    for part in ("train", "test"):
        batch = _rows(spark, sf_dir).where(F.col("split") == part)
        batch.drop("split", "fold").write.mode("append").parquet(folder)
        running.update(spark, folder, state)
    return running.current(spark, folder, state)


def running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.basic_stats(_growing(spark, sf_dir), digits=4)


def running_member_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.member_averages(_growing(spark, sf_dir), digits=4)


def running_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.distinct_count(_growing(spark, sf_dir), "province")


def insight_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.insight_report(_rows(spark, sf_dir))


# Features


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.value_index(_rows(spark, sf_dir), "category")


def province_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.value_index(_rows(spark, sf_dir), "province")


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases(spark, sf_dir).select(KEY, "split")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test part with their exact shares in every category."""
    rows = purchases(spark, sf_dir).select(KEY, "category")
    return split.with_stratified_split(rows, [KEY], ["category"])


def hashed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases for each place of the provinces, of which ten have one of their own."""
    spec = features.FeatureSpec(unseen="hash", max_categories=18, hash_slots=8)
    rows = _rows(spark, sf_dir)
    table = features.cells(rows, features.fit_features(rows, spec))
    return table.groupBy(F.col("province_index").cast("int").alias("index")).agg(F.sum("n").alias("n"))


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases(spark, sf_dir).select(KEY, "fold")


def age_quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantiles.bin_counts(_rows(spark, sf_dir), "age", AGE_BINS)


def price_quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantiles.bin_counts(_rows(spark, sf_dir), "unit_price", PRICE_BINS)


def onehot_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = features.FeatureSpec(categorical=("province",), bins={}, unseen="error")
    rows = purchases(spark, sf_dir)
    return features.nonzero_entries(rows, features.fit_features(rows, spec), KEY)


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases(spark, sf_dir)
    return features.nonzero_entries(rows, features.fit_features(rows, EXACT_LAYOUT), KEY)


def chi2_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    model = features.fit_features(rows, EXACT_LAYOUT)
    tested = selection.chi_square(features.cells(rows, model), model)
    return _rounded(tested, 6, "statistic")


def chi2_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    model = features.fit_features(rows, EXACT_LAYOUT)
    chosen = selection.ranked_features(features.cells(rows, model), model).where("selected")
    return _rounded(chosen, 6, "statistic", "log_p", p_value=9)


def chi2_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One test for each column, and the columns kept at a false-discovery rate."""
    rows = _rows(spark, sf_dir)
    model = features.fit_features(rows, EXACT_LAYOUT)
    return _rounded(selection.column_tests(features.cells(rows, model), model), 6, "statistic", "log_p")


def training_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of both parts which models are trained and tested on."""
    spec = features.FeatureSpec(relative_error=0.0)
    marked = _marked(spark, sf_dir)
    parts = models.prepare(marked, "held_out", spec)
    return parts.train.unionByName(parts.test)


# Models


def rf_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.accuracy(*_fit(spark, sf_dir, models.random_forest()))


def lr_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.accuracy(*_fit(spark, sf_dir, models.logistic_regression()))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.confusion(*_fit(spark, sf_dir, models.random_forest()))


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fit(spark, sf_dir, models.logistic_regression())
    return models.class_report(models.confusion(fitted, test), fitted.features.labels)


def baseline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall, precision and accuracy of always predicting the most frequent category."""
    parts = models.prepare(_marked(spark, sf_dir), "held_out")
    matrix = models.most_frequent_confusion(parts)
    lines = models.class_report(matrix, parts.features.labels)
    # The accuracy is one row.
    scored = lines.join(F.broadcast(models.confusion_accuracy(matrix)), F.lit(True))
    return _rounded(scored, 9, "recall", "precision", "accuracy")


def baseline_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking and log loss of the categories' shares by gender and membership."""
    parts = models.prepare(_marked(spark, sf_dir), "held_out")
    rated = land(ranking.base_rates(parts, ["gender_index", "is_member_index"]), "base-rates")
    lines = ranking.class_auc(rated, parts.features.labels)
    # The log loss is one row.
    scored = lines.join(F.broadcast(ranking.log_loss(rated).select("log_loss")), F.lit(True))
    return _rounded(scored, 9, "auc", "log_loss")


def class_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the regression's probabilities rank each category."""
    fitted, test = _fit(spark, sf_dir, models.logistic_regression())
    rated = land(ranking.probabilities(fitted, test), "probabilities")
    lines = ranking.class_auc(rated, fitted.features.labels)
    return lines.join(F.broadcast(ranking.log_loss(rated).select("log_loss")), F.lit(True))


def rule_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each column is worth to a fixed rule for the category."""
    columns = ("gender", "is_member", "age")
    table = profile.group_counts(_rows(spark, sf_dir), *columns, "category")

    def rule(df: DataFrame) -> DataFrame:
        young_women = (F.col("gender") == "female") & (F.col("age") < 25)
        guess = F.when(young_women, "PROMO").when(F.col("is_member") == "yes", "STANDARD").otherwise("MEDIUM")
        return df.withColumn("prediction", guess)

    found = explain.expected_importance(table, {c: c for c in columns}, rule, "category")
    return _rounded(found, 9, "accuracy", "permuted_accuracy", "importance")


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fit(spark, sf_dir, models.logistic_regression())
    return explain.permutation_importance(fitted, test)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every held-out purchase with the category expected for it."""
    fitted, _ = _fit(spark, sf_dir, models.logistic_regression(), keyed=True)
    held_out = _marked(spark, sf_dir, keyed=True).where("held_out")
    return fitted.predict(held_out).select(KEY, "category", "predicted_category")


def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _rows(spark, sf_dir).where("split = 'train'")
    forest = {"random forest": models.forest_grid()}
    return models.cross_validate(train, forest, parallelism=PARALLEL_FOLDS)


def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = models.leaderboard(
        _marked(spark, sf_dir), _candidates(), parallelism=PARALLEL_FOLDS
    )
    return table


def halving_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight forests searched by successive halving."""
    rows = purchases(spark, sf_dir).where("split = 'train'").drop("fold")
    grid = {"random forest": models.forest_grid((10, 20), (2, 4, 6, 8))}
    return models.halving(split.with_fold(rows, [KEY], 9), grid, parallelism=PARALLEL_FOLDS)


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fit(spark, sf_dir, models.random_forest())
    return explain.feature_importance(fitted, test)


def source_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fit(spark, sf_dir, models.random_forest())
    return explain.source_importance(explain.feature_importance(fitted, test), fitted)


def lr_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fit(spark, sf_dir, models.logistic_regression())
    return explain.coefficients(fitted, test)


def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _marked(spark, sf_dir)
    table, fitted = models.leaderboard(marked, _candidates(), parallelism=PARALLEL_FOLDS)
    forest = fitted["random forest"]
    return report.model_lines(table, explain.feature_importance(forest, marked), forest)


def _rounded(df: DataFrame, digits: int, *columns: str, **other: int) -> DataFrame:
    places = {**dict.fromkeys(columns, digits), **other}
    return df.withColumns({c: F.round(c, d) for c, d in places.items()})


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        category_counts,
        gender_counts,
        basic_stats,
        member_averages,
        top_provinces,
        province_cardinality,
        gender_share,
        member_share,
        best_worst_category,
        age_band_counts,
        top_age_band,
        gender_category_pivot,
        gender_category_long,
        age_band_category_pivot,
        age_histogram,
        price_histogram,
        age_density,
        price_density,
        running_stats,
        running_member_averages,
        running_cardinality,
        insight_report,
        clean_purchases,
        clean_counts,
        landing_counts,
        rejected_rows,
        ingest_csv,
        ingest_mixed_csv,
        label_index,
        province_index,
        hashed_slots,
        train_test_split,
        stratified_split,
        cv_folds,
        age_quantile_bins,
        price_quantile_bins,
        onehot_province,
        feature_matrix,
        chi2_features,
        chi2_selected,
        chi2_columns,
        training_cells,
        baseline_scores,
        baseline_auc,
        rule_importance,
        rf_accuracy,
        lr_accuracy,
        confusion_matrix,
        class_report,
        class_auc,
        permutation_importance,
        predictions,
        cv_scores,
        model_leaderboard,
        halving_scores,
        feature_importance,
        source_importance,
        lr_coefficients,
        model_report,
    )
}
