"""Chi-square tests of features against the label, and selection by them."""

from __future__ import annotations

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.chi_square import log_tail
from basketlens.operators.features import FeatureModel
from basketlens.schema import TOP_FEATURES
from basketlens.sources.landing import land


def _observed(cells: DataFrame, model: FeatureModel) -> DataFrame:
    """(source_column, v, label, o): purchases by value of each column and label, landed."""
    sources = [
        (c, F.col(f"{c}_index")) for c in dict.fromkeys(s.source_column for s in model.slots)
        if c not in model.spec.bins
    ] + [(c, F.col(f"{c}_bin")) for c in model.spec.bins]
    pairs = F.array(*[F.struct(F.lit(c).alias("source_column"), v.alias("v")) for c, v in sources])
    observed = (
        cells.where(F.col("label") < len(model.labels))
        .select("label", "n", F.inline(pairs))
        .groupBy("source_column", "v", "label")
        .agg(F.sum("n").cast("double").alias("o"))
    )
    # Read several times, and as large as values times labels.
    return land(observed, "observed")


def chi_square(cells: DataFrame, model: FeatureModel) -> DataFrame:
    """Independence statistic and degrees of freedom of each vector slot.

    Needs the cells only. A one-hot slot is tested as "has the value or not", a
    bin slot over its bin numbers. Slots with a single value get 0 and 0.
    """
    observed = _observed(cells, model)
    of_label = observed.groupBy("source_column", "label").agg(F.sum("o").alias("col"))
    of_source = of_label.groupBy("source_column").agg(
        F.sum("col").alias("all"), F.count("*").alias("labels")
    )
    share = F.col("o") * F.col("o") / F.col("col")
    of_value = (
        observed.join(of_label, ["source_column", "label"])
        .groupBy("source_column", "v")
        .agg(F.sum(share).alias("share"), F.sum("o").alias("row"))
    )
    is_bin = F.col("source_column").isin(list(model.spec.bins))
    value = F.when(~is_bin, F.col("v").cast("int"))
    sums = (
        of_value.groupBy("source_column", value.alias("value_index"))
        .agg(
            F.sum("share").alias("share"),
            F.sum(F.col("share") / F.col("row")).alias("ratio"),
            F.count("*").alias("values"),
            F.max("row").alias("row"),
        )
        .join(of_source, "source_column")
    )
    # A bin slot has one row per bin. A one-hot slot has two: "has the value" and
    # "has another value", of which the second follows from the totals.
    rest = F.col("all") - F.col("row")
    excess = F.col("share") - F.col("row") * F.col("row") / F.col("all")
    two_rows = F.when(rest > 0, excess * F.col("all") * F.col("all") / (F.col("row") * rest))
    other_rows = F.when(is_bin, F.col("values") - 1).otherwise(F.when(rest > 0, 1).otherwise(0))
    tested = sums.select(
        "source_column",
        "value_index",
        F.when(is_bin, F.col("all") * (F.col("ratio") - 1)).otherwise(two_rows).alias("statistic"),
        (other_rows * (F.col("labels") - 1)).cast("int").alias("dof"),
    )
    slots = slot_table(model, cells)
    same = (slots["source_column"] == tested["source_column"]) & slots["value_index"].eqNullSafe(
        tested["value_index"]
    )
    return slots.join(tested, same, "left").select(
        slots["slot"],
        slots["feature"],
        slots["source_column"],
        F.greatest(F.coalesce(tested["statistic"], F.lit(0.0)), F.lit(0.0)).alias("statistic"),
        F.coalesce(tested["dof"], F.lit(0)).alias("dof"),
    )


def slot_table(model: FeatureModel, like: DataFrame) -> DataFrame:
    """The vector layout as a table, one line per slot."""
    rows = [(s.number, s.feature, s.source_column, s.value_index) for s in model.slots]
    return like.sparkSession.createDataFrame(
        rows, "slot int, feature string, source_column string, value_index int"
    )


def ranked_features(
    cells: DataFrame,
    model: FeatureModel,
    top: int = TOP_FEATURES,
    ranking: str = "log_p",
) -> DataFrame:
    """Slots with p-value, rank from the strongest, and whether they are among ``top``.

    The default ranks by the logarithm of the p-value, which tells features apart
    on tables of any size. ``"p_value"`` ranks as Spark's own selector does: p-values
    below the step of a double near 1 count as 0 and ties go by slot, so on large
    tables the first slots win. Both slots of a two-valued column say the same, have
    the same p-value, and count as two.
    """
    order = {"p_value": F.col("p_value"), "log_p": F.col("log_p")}[ranking]
    tail = F.exp("log_p")
    tested = (
        chi_square(cells, model)
        .withColumn("log_p", log_tail(F.col("statistic"), F.col("dof")))
        .withColumn("p_value", 1 - (1 - tail))
    )
    # One line per vector slot, of which there are a bounded number.
    position = F.row_number().over(Window.orderBy(order, "slot"))
    return tested.withColumn("rank", position).withColumn("selected", F.col("rank") <= top)


def select_slots(
    cells: DataFrame,
    model: FeatureModel,
    top: int = TOP_FEATURES,
    ranking: str = "log_p",
) -> VectorSlicer:
    """A transformer which keeps the ``top`` slots, in slot order."""
    ranked = ranked_features(cells, model, top, ranking)
    chosen = sorted(r["slot"] for r in ranked.where("selected").select("slot").collect())
    return VectorSlicer(inputCol="features", outputCol="selectedFeatures", indices=chosen)


def column_tests(cells: DataFrame, model: FeatureModel, rate: float = 0.05) -> DataFrame:
    """One test per purchase column over all its values, and the columns kept at a false-discovery rate.

    (source_column, statistic, dof, log_p, rank, selected). A column of any number
    of slots counts once. Columns are selected by the step-up rule: from the
    strongest on to the last whose p-value is at most its rank times ``rate`` over the
    number of columns.
    """
    observed = _observed(cells, model)
    of_label = observed.groupBy("source_column", "label").agg(F.sum("o").alias("col"))
    of_source = of_label.groupBy("source_column").agg(F.sum("col").alias("all"), F.count("*").alias("labels"))
    of_value = (
        observed.join(of_label, ["source_column", "label"])
        .groupBy("source_column", "v")
        .agg(F.sum(F.col("o") * F.col("o") / F.col("col")).alias("share"), F.sum("o").alias("row"))
    )
    sums = of_value.groupBy("source_column").agg(
        F.sum(F.col("share") / F.col("row")).alias("ratio"), F.count("*").alias("values")
    ).join(of_source, "source_column")
    tested = sums.select(
        "source_column",
        F.greatest(F.col("all") * (F.col("ratio") - 1), F.lit(0.0)).alias("statistic"),
        ((F.col("values") - 1) * (F.col("labels") - 1)).cast("int").alias("dof"),
    )
    tested = tested.withColumn("log_p", log_tail(F.col("statistic"), F.col("dof")))
    return _step_up(tested, "source_column", rate)


def _step_up(tested: DataFrame, name: str, rate: float) -> DataFrame:
    """``tested`` with rank from the strongest and whether the step-up rule keeps the line."""
    # A line for each column or slot, of which there are a bounded number.
    every = Window.partitionBy()
    ranked = tested.withColumn("rank", F.row_number().over(Window.orderBy("log_p", name)))
    bound = F.log(F.col("rank") * F.lit(rate) / F.count(F.lit(1)).over(every))
    last = F.max(F.when(F.col("log_p") <= bound, F.col("rank"))).over(every)
    return ranked.withColumn("selected", F.coalesce(F.col("rank") <= last, F.lit(False)))


def discovered_slots(cells: DataFrame, model: FeatureModel, rate: float = 0.05) -> DataFrame:
    """Slots kept at a false-discovery rate: (slot, feature, source_column, log_p, rank, selected).

    The two slots of a two-valued column are one test, which both answer to.
    """
    tested = chi_square(cells, model).withColumn("log_p", log_tail(F.col("statistic"), F.col("dof")))
    one_hot = [s for s in model.slots if s.value_index is not None]
    width = {c: sum(s.source_column == c for s in one_hot) for c in model.indexed}
    twins = [c for c, n in width.items() if n == 2 and c not in model.hashed]
    test = F.when(F.col("source_column").isin(twins), F.col("source_column")).otherwise(F.col("feature"))
    named = tested.withColumn("test", test)
    once = _step_up(named.groupBy("test").agg(F.min("log_p").alias("log_p")), "test", rate)
    return named.drop("log_p").join(once, "test").select(
        "slot", "feature", "source_column", "log_p", "rank", "selected"
    )


def select_discovered(cells: DataFrame, model: FeatureModel, rate: float = 0.05) -> VectorSlicer:
    """A transformer which keeps these slots, in slot order."""
    kept = discovered_slots(cells, model, rate).where("selected").select("slot").collect()
    return VectorSlicer(inputCol="features", outputCol="selectedFeatures", indices=sorted(r["slot"] for r in kept))
