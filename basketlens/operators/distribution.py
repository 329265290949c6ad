"""Histogram and density curve of a numeric column, computed on the cluster."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.schema import HISTOGRAM_BINS

DENSITY_POINTS = 200


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins from min to max, empty bins included.

    The last bin is closed. A constant column gives a single bin.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    bounds = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("b"))
    spread = values.withColumn("b", bounds.scalar())
    scaled = (F.col("x") - F.col("b.lo")) * bins / (F.col("b.hi") - F.col("b.lo"))
    # A value close to the upper end can round up to the bin past the last one.
    slot = F.when(F.col("b.hi") > F.col("b.lo"), F.least(F.floor(scaled), F.lit(bins - 1)))
    counts = (
        spread.select(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    grid = (
        bounds.where("b.lo IS NOT NULL")
        .withColumn("last", F.when(F.col("b.hi") > F.col("b.lo"), bins - 1).otherwise(0))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select(
            "bin",
            (F.col("b.lo") + F.col("bin") * width).alias("lower"),
            (F.col("b.lo") + (F.col("bin") + 1) * width).alias("upper"),
        )
    )
    return grid.join(counts, "bin", "left").na.fill(0, subset=["n"])


def density(
    df: DataFrame,
    column: str,
    points: int = DENSITY_POINTS,
    bins: int = HISTOGRAM_BINS,
    resolution: float | None = None,
) -> DataFrame:
    """Gaussian kernel density at ``points`` places from min to max.

    Rows are counted per distinct value first, so the kernel runs over distinct
    values times points. For a column with very many values give ``resolution``:
    values are then rounded to multiples of it before counting. ``curve`` is the
    density on the scale of a histogram with ``bins`` bins. The bandwidth is the
    sample deviation times n^(-1/5). A constant column gives no rows.
    """
    value = F.col(column).cast("double")
    if resolution is not None:
        value = F.round(value / resolution) * resolution
    counts = (
        df.select(value.alias("x"))
        .where("x IS NOT NULL")
        .groupBy("x")
        .agg(F.count("*").alias("n"))
    )
    raw = df.select(F.col(column).cast("double").alias("x"))
    shape = raw.agg(
        F.struct(
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
            F.count("x").alias("total"),
            (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
        ).alias("s")
    )
    place = F.col("s.lo") + (F.col("s.hi") - F.col("s.lo")) * F.col("point") / (points - 1)
    z = (F.col("at") - F.col("x")) / F.col("s.h")
    norm = F.col("s.total") * F.col("s.h") * math.sqrt(2 * math.pi)
    return (
        counts.withColumn("s", shape.scalar())
        .where(F.col("s.h") > 0)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("at", place)
        .groupBy("point")
        .agg(F.sum(F.col("n") * F.exp(-z * z / 2)).alias("mass"))
        .withColumn("s", shape.scalar())
        .withColumn("density", F.col("mass") / norm)
        .select(
            "point",
            place.alias("x"),
            "density",
            (
                F.col("density") * F.col("s.total") * (F.col("s.hi") - F.col("s.lo")) / bins
            ).alias("curve"),
        )
    )


def binned_density(
    df: DataFrame,
    column: str,
    points: int = DENSITY_POINTS,
    bins: int = HISTOGRAM_BINS,
    cutoff: float = 5.0,
    fineness: int = 4,
) -> DataFrame:
    """``density`` for a column of any number of values, in one pass over them.

    Every value is shared between the two nearest nodes of a grid, by its distance
    from them; only sums per node are shuffled. The grid has a whole number of
    nodes between two points of the curve, so many that ``fineness`` of them lie
    within a bandwidth. Then each node reaches the points within ``cutoff``
    bandwidths. Against the sum over all values, at the defaults, the curve is off
    by at most 1/128 of its peak, from the grid, and by exp(-12.5) from the cut.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    shape = values.agg(
        F.struct(
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
            F.count("x").alias("total"),
            (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("h"),
        ).alias("s")
    )
    gap = (F.col("s.hi") - F.col("s.lo")) / (points - 1)
    spread = values.withColumn("s", shape.scalar()).where(F.col("s.h") > 0)
    between = F.ceil(fineness * gap / F.col("s.h"))
    spread = spread.withColumn("width", gap / between).withColumn("last", between * (points - 1) - 1)
    place = (F.col("x") - F.col("s.lo")) / F.col("width")
    left = F.least(F.floor(place), F.col("last"))
    sums = spread.select(left.alias("node"), (place - left).alias("part")).groupBy("node").agg(
        F.count("*").alias("n"), F.sum("part").alias("part")
    )
    shares = F.array(
        F.struct(F.col("node"), (F.col("n") - F.col("part")).alias("mass")),
        F.struct((F.col("node") + 1).alias("node"), F.col("part").alias("mass")),
    )
    nodes = sums.select(F.inline(shares)).groupBy("node").agg(F.sum("mass").alias("mass"))
    h, lo = F.col("s.h"), F.col("s.lo")
    nodes = nodes.withColumn("s", shape.scalar()).withColumn("at", F.col("node") * gap / between)
    first = F.greatest(F.ceil((F.col("at") - cutoff * h) / gap), F.lit(0))
    final = F.least(F.floor((F.col("at") + cutoff * h) / gap), F.lit(points - 1))
    reached = nodes.where(first <= final).withColumn("point", F.explode(F.sequence(first, final)))
    z = (F.col("point") * gap - F.col("at")) / h
    curve = reached.groupBy("point").agg(F.sum(F.col("mass") * F.exp(-z * z / 2)).alias("mass"))
    grid = (
        shape.where("s.h > 0")
        .withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
        .join(curve, "point", "left")
    )
    density_ = F.coalesce("mass", F.lit(0.0)) / (F.col("s.total") * h * math.sqrt(2 * math.pi))
    return grid.withColumn("density", density_).select(
        F.col("point").cast("int").alias("point"),
        (lo + F.col("point") * gap).alias("x"),
        "density",
        (F.col("density") * F.col("s.total") * (F.col("s.hi") - lo) / bins).alias("curve"),
    )
