"""Counts over two attributes, wide or long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.expressions import band
from basketlens.operators.profile import group_counts
from basketlens.schema import AGE_CUTS


def known_values(df: DataFrame, column: str, at_most: int) -> list:
    """The sorted distinct values; an error when there are more than ``at_most``."""
    value = F.col(quoted(column))
    rows = df.select(value).where(value.isNotNull()).distinct().limit(at_most + 1)
    values = sorted(row[0] for row in rows.collect())
    if len(values) > at_most:
        raise ValueError(f"{column} has over {at_most} values: use cross_counts, the long form")
    return values


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def pivot_counts(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence | None = None,
    max_values: int | None = None,
) -> DataFrame:
    """One line per ``row`` value, one column per ``column`` value, 0 for no purchases.

    With ``values`` given, no job runs before the result is asked for. By default
    there may be as many as ``spark.sql.pivotMaxValues`` allows. A value may have any
    name but that of the row column.
    """
    if max_values is None:
        max_values = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    values = known_values(df, column, max_values) if values is None else list(values)
    names = [str(v) for v in values]
    if row in names:
        raise ValueError(f"{column} has a value called {row}, like the row column")
    # Filled by position: names with dots or backticks need no parsing then.
    wide = (
        df.select(F.col(quoted(row)).alias("row"), F.col(quoted(column)).alias("value"))
        .groupBy("row")
        .pivot("value", values)
        .agg(F.count(F.lit(1)))
    )
    numbered = wide.toDF("row", *[f"v{i}" for i in range(len(values))])
    filled = [F.coalesce(f"v{i}", F.lit(0)).alias(name) for i, name in enumerate(names)]
    return numbered.select(F.col("row").alias(row), *filled)


def cross_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """The same counts in long form, for attributes with many values."""
    return group_counts(df, row, column)


def with_age_band(df: DataFrame, cuts: Sequence[int] = AGE_CUTS) -> DataFrame:
    return df.withColumn("age_band", band(F.col("age"), cuts))
