"""Classifiers for the category a customer buys, trained on weighted cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    ClassificationModel,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, VectorSlicer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from basketlens.operators.features import FeatureModel, FeatureSpec, cells, fit_feature_models
from basketlens.operators.selection import select_slots
from basketlens.schema import (
    CV_FOLDS,
    FOREST_DEPTH,
    FOREST_TREES,
    REGRESSION_ITERATIONS,
    REGRESSION_PENALTY,
    SEED,
    TOP_FEATURES,
)
from basketlens.sources.landing import land

BOOTSTRAP_UNITS = 500
# Partitions of the training rows. A forest's draws depend on the number, so it
# is a parameter and does not follow the size of the table or of the cluster.
TRAINING_PARTITIONS = 16
# A regression visits its cells in every iteration, and small tasks cost more than they do.
REGRESSION_CELLS = 20_000


def random_forest(
    trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label",
        featuresCol="selectedFeatures",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        cacheNodeIds=True,
    )


def logistic_regression(
    iterations: int = REGRESSION_ITERATIONS, penalty: float = REGRESSION_PENALTY
) -> LogisticRegression:
    return LogisticRegression(
        labelCol="label",
        featuresCol="selectedFeatures",
        weightCol="weight",
        maxIter=iterations,
        regParam=penalty,
    )


def forest_grid(
    trees: Sequence[int] = (FOREST_TREES,), depths: Sequence[int] = (FOREST_DEPTH,)
) -> tuple[RandomForestClassifier, list[dict]]:
    """A forest and the parameter maps to try on it."""
    forest = random_forest()
    builder = ParamGridBuilder().addGrid(forest.numTrees, list(trees))
    return forest, builder.addGrid(forest.maxDepth, list(depths)).build()


@dataclass(frozen=True)
class FittedModel:
    """Feature stages, selected slots and classifier, learnt from one training set."""

    features: FeatureModel
    slicer: VectorSlicer
    classifier: ClassificationModel

    def pipeline(self) -> PipelineModel:
        """The whole model as one Spark transformer over purchase rows."""
        names = IndexToString(
            inputCol="prediction", outputCol="predicted_category", labels=self.features.labels
        )
        return PipelineModel(stages=[*self.features.stages, self.slicer, self.classifier, names])

    def predict(self, df: DataFrame) -> DataFrame:
        """Purchases with the category the model expects."""
        made = set(self.pipeline().transform(df.limit(0)).columns) - set(df.columns)
        return self.pipeline().transform(df).drop(*(made - {"predicted_category"}))

    def score(self, cells: DataFrame) -> DataFrame:
        """Cells, merged to what the model can tell apart, with their predicted label."""
        merged = merge_cells(cells, self.features, self.slicer)
        return self.classifier.transform(self.slicer.transform(self.features.vectors(merged)))


def merge_cells(cells: DataFrame, model: FeatureModel, slicer: VectorSlicer, *also_by: str) -> DataFrame:
    """Cells counted again, with what the selected slots do not tell apart put together.

    A category value without a selected slot gets the number which the encoder
    turns into no slot at all, and a bin column which is not selected gets bin 0,
    so the selected part of the vector stays the same.
    """
    chosen = set(slicer.getIndices())
    merged = {}
    for name, source in zip(model.index_columns, model.indexed):
        own = [s for s in model.slots if s.source_column == source]
        shown = [float(s.value_index) for s in own if s.number in chosen]
        number = F.col(name)
        merged[name] = F.when(number.isin(shown), number).otherwise(float(len(own)))
    for name, source in zip(model.bin_columns, model.spec.bins):
        (slot,) = [s for s in model.slots if s.source_column == source]
        merged[name] = F.col(name) if slot.number in chosen else F.lit(0.0)
    by = [
        value.alias(name, metadata=cells.schema[name].metadata) for name, value in merged.items()
    ]
    return cells.groupBy(*also_by, *by, "label").agg(F.sum("n").alias("n"))


def _placed(df: DataFrame, partitions: int) -> DataFrame:
    """Rows placed and ordered by value, so that a fit does not depend on the cluster."""
    by = [c for c in df.columns if c != "weight"]
    return df.repartition(partitions, *by).sortWithinPartitions(*by)


def training_units(
    cells: DataFrame,
    units: int | None = BOOTSTRAP_UNITS,
    partitions: int = TRAINING_PARTITIONS,
) -> DataFrame:
    """Cells spread over up to ``units`` weighted rows each, for bootstrapping.

    A forest draws rows, not weights. A cell of at most ``units`` purchases gives
    one row of weight 1 per purchase, so the forest is trained as on the purchases
    themselves; in a larger cell each row stands for an equal part of it. Weights
    always add up to the number of purchases. With ``units=None`` every purchase
    is a row.
    """
    pieces = F.col("n") if units is None else F.least(F.col("n"), F.lit(units))
    spread = cells.withColumn("weight", F.col("n") / pieces).withColumn(
        "unit", F.explode(F.sequence(F.lit(1).cast("bigint"), pieces))
    )
    return _placed(spread.drop("n"), partitions)


def _fit_forest(forest, known: DataFrame, model, slicer, units: int | None, partitions: int):
    # Trees take bin numbers as categories, and need room for all of them.
    most = max((len(s) - 1 for s in model.bucketizer.getSplitsArray()), default=0)
    roomy = forest.copy({forest.maxBins: max(forest.getMaxBins(), most)})
    rows = training_units(known, units, partitions)
    return roomy.fit(slicer.transform(model.vectors(rows)))


def _fit_regression(regression, known: DataFrame, size: Row, model, slicer, partitions: int):
    weighted = known.withColumn("weight", F.col("n").cast("double")).drop("n")
    # Spark divides the variance of weighted rows by rows - squares/rows, not by
    # rows - 1, and the penalty is scaled by that variance. Undo the difference,
    # so that the fit equals the one on single purchases.
    free = size["rows"] - size["squares"] / size["rows"]
    factor = free / (size["rows"] - 1) if free > 0 else 1.0
    corrected = regression.copy({regression.regParam: regression.getRegParam() * factor})
    placed = _placed(weighted, min(partitions, -(-size["cells"] // REGRESSION_CELLS)))
    return corrected.fit(slicer.transform(model.vectors(placed)))


def fit_classifier(
    classifier: RandomForestClassifier | LogisticRegression,
    cells: DataFrame,
    model: FeatureModel,
    slicer: VectorSlicer,
    units: int | None = BOOTSTRAP_UNITS,
    partitions: int = TRAINING_PARTITIONS,
) -> FittedModel:
    """Train a forest or a regression on the cells whose label is known.

    ``units`` is how finely a forest can draw from one cell; see ``training_units``.
    Raises when there is no purchase, or no feature, to learn from.
    """
    if not slicer.getIndices():
        raise ValueError("no feature takes more than one value in the training purchases")
    # Without the extra "unseen" value in the metadata, classes are the known labels.
    nominal = {"ml_attr": {"type": "nominal", "name": "label", "vals": model.labels}}
    known = merge_cells(cells, model, slicer).where(F.col("label") < len(model.labels))
    weight = F.col("n").cast("double")
    size = known.agg(
        F.count("*").alias("cells"), F.sum(weight).alias("rows"), F.sum(weight * weight).alias("squares")
    ).first()
    if not size["cells"]:
        raise ValueError("there are no purchases of known category to train on")
    known = known.withMetadata("label", nominal)
    if isinstance(classifier, RandomForestClassifier):
        trained = _fit_forest(classifier, known, model, slicer, units, partitions)
    else:
        trained = _fit_regression(classifier, known, size, model, slicer, partitions)
    return FittedModel(model, slicer, trained)


def confusion(fitted: FittedModel, cells: DataFrame) -> DataFrame:
    """Purchases per known category and predicted category."""
    labels = F.array(*[F.lit(v) for v in fitted.features.labels])

    def named(column: str):
        return F.element_at(labels, F.col(column).cast("int") + 1)

    known = cells.where(F.col("label") < len(fitted.features.labels))
    return (
        fitted.score(known)
        .groupBy("label", "prediction")
        .agg(F.sum("n").alias("n"))
        .select(named("label").alias("category"), named("prediction").alias("predicted"), "n")
    )


def most_frequent_confusion(prepared: Prepared) -> DataFrame:
    """What ``confusion`` gives if the most frequent training category is always predicted."""
    labels = prepared.features.labels
    named = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("label").cast("int") + 1)
    known = prepared.test.where(F.col("label") < len(labels)) if labels else prepared.test.limit(0)
    return known.groupBy("label").agg(F.sum("n").alias("n")).select(
        named.alias("category"), F.lit(labels[0] if labels else None).alias("predicted"), "n"
    )


def confusion_accuracy(matrix: DataFrame) -> DataFrame:
    """One row: the share of purchases predicted right."""
    right = F.sum(F.when(F.col("category") == F.col("predicted"), F.col("n")).otherwise(0))
    return matrix.agg(F.try_divide(right, F.sum("n")).alias("accuracy"))


def class_report(matrix: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Recall and precision of each category, from a confusion table.

    There is a line for every category that occurs, is predicted, or is among
    ``labels``: with 0 rows and a null recall or precision where there is nothing.
    """
    hit = F.sum(F.when(F.col("category") == F.col("predicted"), F.col("n")).otherwise(0))
    recall = matrix.groupBy("category").agg(
        F.sum("n").alias("n"), (hit / F.sum("n")).alias("recall")
    )
    precision = matrix.groupBy(F.col("predicted").alias("category")).agg(
        (hit / F.sum("n")).alias("precision")
    )
    known = matrix.sparkSession.createDataFrame([(v,) for v in labels], "category string")
    return (
        recall.join(precision, "category", "full")
        .join(known, "category", "full")
        .select("category", F.coalesce("n", F.lit(0)).alias("n"), "recall", "precision")
    )


def accuracy(fitted: FittedModel, cells: DataFrame) -> DataFrame:
    """One row: share of purchases predicted right, and how many had an unknown label."""
    known = F.col("label") < len(fitted.features.labels)
    right = F.when(known & (F.col("label") == F.col("prediction")), F.col("n")).otherwise(0)
    return fitted.score(cells).agg(
        F.try_divide(F.sum(right), F.sum(F.when(known, F.col("n")))).alias("accuracy"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_scored"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_skipped"),
    )


@dataclass(frozen=True)
class Prepared:
    """Feature stages fitted on the training part, and cells of both parts."""

    features: FeatureModel
    slicer: VectorSlicer
    train: DataFrame
    test: DataFrame


def prepare(
    marked: DataFrame,
    held_out: str,
    spec: FeatureSpec = FeatureSpec(),
    top: int = TOP_FEATURES,
    ranking: str = "log_p",
    model: FeatureModel | None = None,
    merge: bool = False,
) -> Prepared:
    """Fit features where the boolean column ``held_out`` is false; count cells of both.

    One pass over the purchases counts the cells of the two parts together. A
    ``model`` which was fitted already is taken as it is. With ``merge`` the cells are
    those of ``merge_cells``, written once for all fits and scores that follow.
    """
    if model is None:
        model = fit_feature_models(marked, {"train": ~F.col(held_out)}, spec)["train"]
    both = cells(marked, model, held_out)
    slicer = select_slots(both.where(~F.col(held_out)), model, top, ranking)
    if merge:
        both = land(merge_cells(both, model, slicer, held_out), "merged-cells")
    return Prepared(model, slicer, both.where(~F.col(held_out)), both.where(held_out))


def _fold_parts(folds: int, train: Column) -> dict[int, Column]:
    """For each fold, the training purchases outside it."""
    return {fold: train & (F.col("fold") != fold) for fold in range(folds)}


def cross_validate(
    train: DataFrame,
    candidates: dict[str, tuple],
    folds: int = CV_FOLDS,
    spec: FeatureSpec = FeatureSpec(),
    top: int = TOP_FEATURES,
    parallelism: int = 1,
    units: int | None = BOOTSTRAP_UNITS,
    ranking: str = "log_p",
    feature_models: dict[int, FeatureModel] | None = None,
    partitions: int = TRAINING_PARTITIONS,
) -> DataFrame:
    """Accuracy of every candidate on every fold: ``(model, point, params, fold, accuracy)``.

    ``train`` has a ``fold`` column numbered from 0. ``candidates`` maps a name to
    ``(estimator, parameter maps)``. Feature stages are fitted once per fold, on
    the other folds only and for all folds in the same passes, and shared by all
    points.
    """
    spark = train.sparkSession
    if feature_models is None:
        feature_models = fit_feature_models(train, _fold_parts(folds, F.lit(True)), spec)

    @inheritable_thread_target(spark)
    def run(fold: int) -> list[tuple]:
        marked = train.withColumn("held_out", F.col("fold") == fold)
        parts = prepare(marked, "held_out", spec, top, ranking, feature_models[fold], merge=True)
        scores = []
        for name, (estimator, grid) in candidates.items():
            for point, params in enumerate(grid or [{}]):
                fitted = fit_classifier(
                    estimator.copy(params), parts.train, parts.features, parts.slicer, units, partitions
                )
                value = accuracy(fitted, parts.test).first()["accuracy"]
                shown = ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))
                scores.append((name, point, shown, fold, value))
        return scores

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        scores = [row for rows in pool.map(run, range(folds)) for row in rows]
    return spark.createDataFrame(
        scores, "model string, point int, params string, fold int, accuracy double"
    )


def average_scores(scores: DataFrame) -> DataFrame:
    """Mean accuracy over the folds for each candidate and parameter point."""
    return scores.groupBy("model", "point", "params").agg(F.avg("accuracy").alias("cv_accuracy"))


def leaderboard(
    marked: DataFrame,
    candidates: dict[str, tuple],
    folds: int = CV_FOLDS,
    spec: FeatureSpec = FeatureSpec(),
    top: int = TOP_FEATURES,
    parallelism: int = 1,
    units: int | None = BOOTSTRAP_UNITS,
    ranking: str = "log_p",
    partitions: int = TRAINING_PARTITIONS,
) -> tuple[DataFrame, dict[str, FittedModel]]:
    """Candidates compared: chosen by cross-validation, reported on the test part.

    ``marked`` has a boolean ``held_out`` and a ``fold`` column. Returns ``(model,
    params, cv_accuracy, test_accuracy, is_best)`` and the refitted models. Training
    runs in ``partitions`` tasks: more suit ``units=None`` on a large table.
    """
    known = ~F.col("held_out")
    feature_models = fit_feature_models(marked, {**_fold_parts(folds, known), "all": known}, spec)
    train = marked.where("NOT held_out").drop("held_out")
    scores = cross_validate(
        train, candidates, folds, spec, top, parallelism, units, ranking, feature_models, partitions
    )
    # One line per candidate and parameter point.
    lines = average_scores(scores).orderBy(F.desc("cv_accuracy"), "point").collect()
    parts = prepare(marked, "held_out", spec, top, ranking, feature_models["all"], merge=True)
    rows, fitted = [], {}
    for name, (estimator, grid) in candidates.items():
        line = next(r for r in lines if r["model"] == name)
        params = (grid or [{}])[line["point"]]
        fitted[name] = fit_classifier(
            estimator.copy(params), parts.train, parts.features, parts.slicer, units, partitions
        )
        test = accuracy(fitted[name], parts.test).first()["accuracy"]
        rows.append((name, line["params"], line["cv_accuracy"], test))
    best = max(rows, key=lambda r: r[2])[0]
    table = train.sparkSession.createDataFrame(
        [(*row, row[0] == best) for row in rows],
        "model string, params string, cv_accuracy double, test_accuracy double, is_best boolean",
    )
    return table, fitted


def halving(
    train: DataFrame,
    candidates: dict[str, tuple],
    rungs: int = 4,
    spec: FeatureSpec = FeatureSpec(),
    top: int = TOP_FEATURES,
    parallelism: int = 1,
    units: int | None = BOOTSTRAP_UNITS,
    ranking: str = "log_p",
    partitions: int = TRAINING_PARTITIONS,
) -> DataFrame:
    """Search a grid by successive halving: all points on few purchases, the better half on more.

    ``train`` has a ``fold`` column of ``2**(rungs - 1) + 1`` folds, as ``with_fold``
    gives. Fold 0 scores every fit; rung r trains on ``2**r`` of the others, and the
    better half of its points goes on, ties to the point that comes first. One pass
    over the purchases counts the cells of all folds, and every rung reads those.
    Returns (rung, model, point, params, share, accuracy, is_best): ``share`` is the
    part of a full fit, so its sum says what the search cost in full fits.
    """
    spark = train.sparkSession
    folds = 2 ** (rungs - 1)
    learning = F.col("fold").between(1, folds)
    model = fit_feature_models(train, {"train": learning}, spec)["train"]
    table = cells(train, model, "fold")
    slicer = select_slots(table.where(learning), model, top, ranking)
    table = land(merge_cells(table, model, slicer, "fold"), "merged-cells")
    scoring = table.where("fold = 0")
    points = [
        (name, point, estimator.copy(params), ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())))
        for name, (estimator, grid) in candidates.items() for point, params in enumerate(grid or [{}])
    ]
    rows: list[tuple] = []
    for rung in range(rungs):
        part = table.where(F.col("fold").between(1, 2**rung))

        @inheritable_thread_target(spark)
        def score(candidate: tuple) -> float:
            fitted = fit_classifier(candidate[2], part, model, slicer, units, partitions)
            return accuracy(fitted, scoring).first()["accuracy"] or 0.0

        with ThreadPool(max(1, min(parallelism, len(points)))) as pool:
            values = pool.map(score, points)
        order = sorted(range(len(points)), key=lambda i: -values[i])
        best = order[0] if rung == rungs - 1 or len(points) == 1 else None
        rows += [
            (rung, name, point, params, 2**rung / folds, values[i], i == best)
            for i, (name, point, _, params) in enumerate(points)
        ]
        if best is not None:
            break
        points = [points[i] for i in sorted(order[: -(-len(points) // 2)])]
    return spark.createDataFrame(
        rows,
        "rung int, model string, point int, params string, share double, accuracy double, is_best boolean",
    )
