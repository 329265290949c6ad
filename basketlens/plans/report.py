"""The insight report and chart tables, as plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.expressions import band, percent
from basketlens.operators import crosstab, distribution, profile
from basketlens.operators.explain import source_importance
from basketlens.schema import AGE_CUTS, PurchaseValues


def insight_report(
    df: DataFrame,
    values: PurchaseValues = PurchaseValues(),
    cuts: Sequence[int] = AGE_CUTS,
) -> DataFrame:
    """Report lines ``(section, metric, item, value)`` from one pass over the purchases.

    Purchases are counted by the four attributes once; totals, shares and
    rankings all come from those counts.
    """
    base = (
        df.select("gender", "is_member", "category", band(F.col("age"), cuts).alias("age_band"),
                  "age", "unit_price")
        .groupBy("gender", "is_member", "category", "age_band")
        .agg(
            F.count("*").alias("n"),
            F.sum("age").alias("age"),
            F.sum("unit_price").alias("unit_price"),
        )
    )
    sets = [["gender"], ["is_member"], ["category"], ["age_band"], []]
    level = F.grouping_id()
    by_value = base.groupingSets(
        [[F.col(c) for c in s] for s in sets], "gender", "is_member", "category", "age_band"
    ).agg(
        level.alias("level"),
        F.sum("n").alias("n"),
        F.sum("age").alias("age"),
        F.sum("unit_price").alias("unit_price"),
    )
    # grouping_id sets a bit for each column left out, the first column highest.
    ids = {"gender": 7, "is_member": 11, "category": 13, "age_band": 14, "all": 15}

    def at(name: str, value: Column) -> Column:
        return F.when(F.col("level") == ids[name], value)

    def leader(name: str, order: Column) -> Column:
        hit = (F.col("level") == ids[name]) & F.col(name).isNotNull()
        return F.min(F.when(hit, F.struct(order.alias("o"), F.col(name).alias("value"))))

    n = F.col("n")
    one_row = by_value.agg(
        F.max(at("all", n)).alias("total"),
        F.max(at("all", F.try_divide(F.col("age"), n))).alias("avg_age"),
        F.max(at("all", F.try_divide(F.col("unit_price"), n))).alias("avg_unit_price"),
        F.coalesce(F.max(at("gender", F.when(F.col("gender") == values.female, n))), F.lit(0))
        .alias("female"),
        F.coalesce(F.max(at("is_member", F.when(F.col("is_member") == values.member, n))), F.lit(0))
        .alias("members"),
        leader("category", -n).alias("best"),
        leader("category", n).alias("worst"),
        leader("age_band", -n).alias("band"),
    )
    total = F.col("total")
    best_n, worst_n = -F.col("best.o"), F.col("worst.o")

    def line(section: str, metric: str, item: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(metric).alias("metric"),
            item.alias("item"),
            value.cast("double").alias("value"),
        )

    nothing = F.lit("")
    lines = [
        line("base", "purchases", nothing, F.coalesce(total, F.lit(0))),
        line("base", "average age", nothing, F.round("avg_age", 2)),
        line("base", "average unit price", nothing, F.round("avg_unit_price", 2)),
        line("base", "female share", F.lit(values.female), percent(F.col("female"), total, 2)),
        line("base", "member share", F.lit(values.member), percent(F.col("members"), total, 2)),
        line("sales", "best seller", F.col("best.value"), best_n),
        line("sales", "best seller share", F.col("best.value"), percent(best_n, total, 2)),
        line("sales", "worst seller", F.col("worst.value"), worst_n),
        line("sales", "worst seller share", F.col("worst.value"), percent(worst_n, total, 2)),
        line(
            "advice",
            "promote to age band",
            F.concat_ws(": ", F.col("band.value"), F.col("best.value")),
            -F.col("band.o"),
        ),
    ]
    return one_row.select(F.inline(F.array(*lines)))


def model_lines(board: DataFrame, importance: DataFrame, fitted) -> DataFrame:
    """Report lines about the models: accuracies, the choice, column importances."""
    scores = board.select(
        F.lit("models").alias("section"),
        F.lit("test accuracy").alias("metric"),
        F.col("model").alias("item"),
        F.round("test_accuracy", 4).alias("value"),
    )
    best = board.where("is_best").select(
        F.lit("models").alias("section"),
        F.lit("best model by cross-validation").alias("metric"),
        F.col("model").alias("item"),
        F.round("cv_accuracy", 4).alias("value"),
    )
    chosen = board.where("params <> ''").select(
        F.lit("models").alias("section"),
        F.lit("chosen parameters").alias("metric"),
        F.concat_ws(": ", "model", "params").alias("item"),
        F.lit(None).cast("double").alias("value"),
    )
    columns = source_importance(importance, fitted).select(
        F.lit("importance").alias("section"),
        F.lit("column importance").alias("metric"),
        F.col("source_column").alias("item"),
        F.round("importance", 4).alias("value"),
    )
    return scores.unionByName(best).unionByName(chosen).unionByName(columns)


def cleaning_lines(counts: DataFrame) -> DataFrame:
    """Report lines about cleaning, from the one row of ``clean_counts``."""
    lines = [
        F.struct(
            F.lit("cleaning").alias("section"), F.lit(metric).alias("metric"),
            F.lit("").alias("item"), F.col(column).cast("double").alias("value"),
        )
        for metric, column in (("rows read", "rows_in"), ("rows kept", "rows_kept"))
    ]
    return counts.select(F.inline(F.array(*lines)))


def chart_tables(
    df: DataFrame, cuts: Sequence[int] = AGE_CUTS, importance: DataFrame | None = None
) -> dict[str, DataFrame]:
    """One plot-ready table per chart: of the customer base, and of a model if given.

    ``importance`` is what ``explain.feature_importance`` gives.
    """
    banded = crosstab.with_age_band(df, cuts)
    of_model = {} if importance is None else {"feature_importance": importance}
    return of_model | {
        "category_distribution": profile.group_counts(df, "category"),
        "age_histogram": distribution.histogram(df, "age"),
        "age_density": distribution.density(df, "age"),
        "gender_category": crosstab.cross_counts(df, "gender", "category"),
        "age_category": crosstab.cross_counts(banded, "age_band", "category"),
        "member_stats": profile.member_averages(df),
        "province_distribution": profile.top_groups(df, "province"),
    }
