"""Statistics, group counts, shares and rankings of the customer base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.expressions import band, percent
from basketlens.schema import AGE_CUTS, TOP_PROVINCES


def basic_stats(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, min and max of each column, in one pass."""

    def shown(value):
        return value if digits is None else F.round(value, digits)

    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                shown(F.avg(c)).alias("mean"),
                shown(F.stddev_samp(c)).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return one_row.select(F.inline(F.array(*columns)))


def group_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def age_band_counts(df: DataFrame, cuts: Sequence[int] = AGE_CUTS) -> DataFrame:
    return group_counts(df.select(band(F.col("age"), cuts).alias("age_band")), "age_band")


def member_averages(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Average price and age of members and of non-members."""

    def shown(value):
        return value if digits is None else F.round(value, digits)

    return df.groupBy("is_member").agg(
        shown(F.avg("unit_price")).alias("avg_unit_price"),
        shown(F.avg("age")).alias("avg_age"),
    )


def top_groups(df: DataFrame, column: str, k: int = TOP_PROVINCES) -> DataFrame:
    """The ``k`` most frequent values, ties in value order."""
    return group_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """How many different values a column has; optionally by a fixed-size sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n_distinct"))


def value_share(df: DataFrame, column: str, value: str, digits: int = 2) -> DataFrame:
    """How many rows hold ``value``, and their percentage; 0 when there are none."""
    hits, rows = F.count_if(F.col(column) == value), F.count("*")
    return df.agg(
        hits.alias("n"), rows.alias("total"), percent(hits, rows, digits).alias("share")
    )


def best_and_worst(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """The most and the least frequent value with their shares, ties in value order."""
    value, n = F.col(column), F.col("n")
    one_row = group_counts(df, column).agg(
        F.sum("n").alias("total"),
        F.min(F.struct((-n).alias("order"), value.alias("value"))).alias("best"),
        F.min(F.struct(n.alias("order"), value.alias("value"))).alias("worst"),
    )
    entries = [
        F.struct(
            F.lit(rank).alias("rank"),
            F.col(f"{rank}.value").alias(column),
            F.abs(F.col(f"{rank}.order")).alias("n"),
            percent(F.abs(F.col(f"{rank}.order")), F.col("total"), digits).alias("share"),
        )
        for rank in ("best", "worst")
    ]
    return one_row.where("total IS NOT NULL").select(F.inline(F.array(*entries)))


def top_age_band(df: DataFrame, cuts: Sequence[int] = AGE_CUTS) -> DataFrame:
    """The age band with most purchases."""
    counts = age_band_counts(df, cuts).where(F.col("age_band").isNotNull())
    return counts.orderBy(F.desc("n"), F.asc("age_band")).limit(1)
