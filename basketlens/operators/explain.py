"""What a fitted model relies on, by feature name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.models import FittedModel, merge_cells
from basketlens.operators.selection import slot_table
from basketlens.sources.landing import land


def feature_importance(fitted: FittedModel, like: DataFrame) -> DataFrame:
    """Importance of every vector slot of a forest; 0 for slots not selected."""
    spark = like.sparkSession
    values = zip(fitted.slicer.getIndices(), fitted.classifier.featureImportances.toArray())
    chosen = spark.createDataFrame(
        [(int(s), float(v)) for s, v in values], "slot int, importance double"
    )
    return (
        slot_table(fitted.features, like)
        .join(chosen, "slot", "left")
        .select(
            "slot",
            "feature",
            "source_column",
            F.coalesce("importance", F.lit(0.0)).alias("importance"),
            F.col("importance").isNotNull().alias("selected"),
        )
    )


def source_importance(importance: DataFrame, fitted: FittedModel) -> DataFrame:
    """Importance summed per purchase column, 0 for columns without a slot."""
    spec = fitted.features.spec
    sources = importance.sparkSession.createDataFrame(
        [(c,) for c in (*spec.categorical, *spec.bins)], "source_column string"
    )
    summed = importance.groupBy("source_column").agg(F.sum("importance").alias("importance"))
    return sources.join(summed, "source_column", "left").na.fill(0.0, subset=["importance"])


def coefficients(fitted: FittedModel, like: DataFrame) -> DataFrame:
    """Coefficients of a regression per category and selected slot."""
    model, labels = fitted.classifier, fitted.features.labels
    matrix = model.coefficientMatrix.toArray()
    # Two categories give a single row, about the second of them.
    names = labels if len(matrix) == len(labels) else labels[1:]
    slots = {s.number: s for s in fitted.features.slots}
    rows = [
        (name, int(number), slots[number].feature, float(value))
        for name, line in zip(names, matrix)
        for number, value in zip(fitted.slicer.getIndices(), line)
    ]
    return like.sparkSession.createDataFrame(
        rows, "category string, slot int, feature string, coefficient double"
    )


def expected_importance(
    cells: DataFrame,
    columns: Mapping[str, str],
    predict: Callable[[DataFrame], DataFrame],
    label: str = "label",
) -> DataFrame:
    """What a predictor loses on average when one column is shuffled, for every column.

    ``cells`` counts purchases (``n``) by the feature columns and ``label``;
    ``columns`` maps a name to its feature column, and ``predict`` adds a
    ``prediction``. Nothing is drawn: a shuffled column takes each of its values with
    its share, whatever the others are, so each combination of the others meets every
    value of the column, weighted. That makes the expectation exact, at a cost of
    cells times values, whatever the number of purchases. Returns (source_column,
    accuracy, permuted_accuracy, importance), with nulls where there are no cells.
    """
    names = list(columns.values())
    about = {c: cells.schema[c].metadata for c in names}
    total = cells.agg(F.sum("n")).scalar()

    def line(df: DataFrame, source: str | None, weight) -> DataFrame:
        return df.select(F.lit(source).cast("string").alias("source_column"), *names, label, weight.alias("weight"))

    tables = [line(cells, None, F.col("n").cast("double"))]
    for source, name in columns.items():
        rest = cells.groupBy(*[c for c in names if c != name], label).agg(F.sum("n").alias("n"))
        # As many values as the column has in the cells.
        counts = cells.groupBy(name).agg(F.sum("n").alias("m"))
        values = counts.agg(F.collect_list(F.struct(F.col(name).alias("value"), "m"))).scalar()
        met = rest.withColumn("all", total).withColumn("met", F.explode(values))
        met = met.withColumn(name, F.col("met.value"))
        tables.append(line(met, source, F.col("n") * (F.col("met.m") / F.col("all"))))
    together = reduce(DataFrame.unionByName, tables)
    together = together.select(
        "source_column", *[F.col(c).alias(c, metadata=about[c]) for c in names], label, "weight"
    )
    right = F.when(F.col("prediction") == F.col(label), F.col("weight")).otherwise(0.0)
    shares = predict(together).groupBy("source_column").agg((F.sum(right) / F.sum("weight")).alias("share"))
    # One line for each column and one for the cells as they are.
    base = F.max(F.when(F.col("source_column").isNull(), F.col("share"))).over(Window.partitionBy())
    lines = shares.withColumn("accuracy", base).where("source_column IS NOT NULL")
    return lines.select(
        "source_column", "accuracy", F.col("share").alias("permuted_accuracy"),
        (F.col("accuracy") - F.col("share")).alias("importance"),
    )


def permutation_importance(fitted: FittedModel, cells: DataFrame) -> DataFrame:
    """``expected_importance`` of a forest or a regression on the cells whose label is known.

    Cells are merged to what the model can tell apart first, so a column has no more
    values than selected slots and one. A column without a selected slot has 0.
    """
    model = fitted.features
    known = cells.where(F.col("label") < len(model.labels))
    merged = land(merge_cells(known, model, fitted.slicer), "merged-cells")
    columns = dict(zip(model.indexed, model.index_columns)) | dict(zip(model.spec.bins, model.bin_columns))

    def predict(df: DataFrame) -> DataFrame:
        return fitted.classifier.transform(fitted.slicer.transform(model.vectors(df)))

    found = expected_importance(merged, columns, predict)
    spec = model.spec
    sources = cells.sparkSession.createDataFrame(
        [(c,) for c in (*spec.categorical, *spec.bins)], "source_column string"
    )
    return sources.join(found, "source_column", "left").na.fill(0.0, subset=["importance"])
