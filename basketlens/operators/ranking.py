"""How well class probabilities rank and fit, counted on cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.models import FittedModel, Prepared
from basketlens.sources.landing import land

# Fixed value: probabilities are kept this far from 0 and 1 under the logarithm.
MARGIN = 1e-15


def probabilities(fitted: FittedModel, cells: DataFrame) -> DataFrame:
    """(label, n, probability): cells of known label with the model's probability of each class."""
    known = cells.where(F.col("label") < len(fitted.features.labels))
    return fitted.score(known).select("label", "n", vector_to_array("probability").alias("probability"))


def base_rates(prepared: Prepared, by: Sequence[str]) -> DataFrame:
    """The same from the share of each class in the training part, within groups of equal ``by``.

    A group that the training part lacks gets the shares of the whole part.
    """
    k = len(prepared.features.labels)
    known = prepared.train.where(F.col("label") < k)

    def shares(*columns: str) -> DataFrame:
        counts = [F.sum(F.when(F.col("label") == i, F.col("n")).otherwise(0)) / F.sum("n") for i in range(k)]
        return known.groupBy(*columns).agg(F.array(*counts).alias("p"))

    held_out = prepared.test.where(F.col("label") < k)
    rated = held_out.join(shares(*by), list(by), "left").withColumn("all", shares().scalar())
    return rated.select("label", "n", F.coalesce("p", "all").alias("probability"))


def class_auc(scored: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(category, n, auc): how often a purchase of the class is rated above one of another.

    Ties count half. Purchases are counted per class and rating first, and these
    counts are dealt to ranges of ratings: a rating's rank is its place in its range
    after the sizes of the ranges before, so no task holds all ratings. A class that
    has no purchases, or all of them, has no ``auc``.
    """
    pairs = scored.select("label", "n", F.posexplode("probability").alias("class", "p"))
    own = F.col("label") == F.col("class")
    counted = pairs.groupBy("class", "p").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(own, 0).otherwise(F.col("n"))).alias("neg"),
    )
    dealt = land(counted.repartitionByRange("class", "p").withColumn("range", F.spark_partition_id()), "ratings")
    before = Window.partitionBy("class").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One line for each class and range.
    starts = dealt.groupBy("class", "range").agg(F.sum("neg").alias("m")).select(
        "class", "range", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start")
    )
    within = F.sum("neg").over(Window.partitionBy("class", "range").orderBy("p")) - F.col("neg")
    ranked = dealt.withColumn("within", within).join(starts, ["class", "range"])
    below = (F.col("start") + F.col("within") + F.col("neg") / 2).cast("double")
    summed = ranked.groupBy("class").agg(
        F.sum("pos").alias("n"), F.sum("neg").alias("others"), F.sum(F.col("pos") * below).alias("won")
    )
    names = scored.sparkSession.createDataFrame(list(enumerate(labels)), "class int, category string")
    pairs_of = F.col("n").cast("double") * F.col("others").cast("double")
    return names.join(summed, "class", "left").select(
        "category", F.coalesce("n", F.lit(0)).alias("n"), F.when(pairs_of > 0, F.col("won") / pairs_of).alias("auc")
    )


def log_loss(scored: DataFrame) -> DataFrame:
    """(n, log_loss): the mean of minus the logarithm of the probability that the true class got."""
    p = F.element_at("probability", F.col("label").cast("int") + 1)
    kept = F.least(F.greatest(p, F.lit(MARGIN)), F.lit(1 - MARGIN))
    return scored.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        (F.sum(-F.log(kept) * F.col("n")) / F.sum("n")).alias("log_loss"),
    )
