"""A global order without a task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.landing import land

# An identifier of ``monotonically_increasing_id`` holds the row's number in its partition here.
_PLACE_BITS = 33


def numbered(rows: DataFrame, keys: list[Column | str], name: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with their numbers from 0 in the order of ``keys``, as column ``name``.

    Rows are dealt to ranges of the order, sorted there, and written; a row's number
    is its place in its range after the sizes of the ranges before. Rows that are
    equal by ``keys`` go by the place that they are read from, so that any number of
    them can be split.
    """
    stored = rows.withColumn("__tie", F.monotonically_increasing_id())
    order = [*keys, F.asc("__tie")]
    dealt = stored.repartitionByRange(ranges, *order) if ranges else stored.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()).drop("__tie")
    placed = land(placed, "ordered").withColumn("__part", F.shiftright("__place", _PLACE_BITS))
    # One line for each range.
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("m")).select(
        "__part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("__start")
    )
    within = F.col("__place").bitwiseAND(2**_PLACE_BITS - 1)
    return placed.join(starts, "__part").select(*rows.columns, (F.col("__start") + within).alias(name))
