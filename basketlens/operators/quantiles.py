"""Cut points which divide a column into groups of equal size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import or_

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.sources.landing import land

INFINITY = float("inf")


def exact_quantiles(
    df: DataFrame,
    column: str,
    groups: int,
    max_values: int = 50_000,
    slices: int = 1000,
) -> list[float]:
    """The values at ranks ``ceil(i*n/groups)`` for ``i`` in ``1..groups-1``.

    A sketch cuts the value range into ``slices`` of about equal weight and one
    pass counts the rows of each. Only rows in the few slices which hold a wanted
    rank are then counted per value and brought to the driver, at most
    ``max_values`` lines; slices with more distinct values are cut again.
    """
    values = df.select(F.col(column).cast("double").alias("x"), F.lit(1).alias("n")).where(
        F.col("x").isNotNull() & ~F.isnan("x")
    )
    edges, totals = _slice(values, slices)
    rows = int(totals.sum())
    ranks = [-(-i * rows // groups) for i in range(1, groups)] if rows else []
    return _search(values, edges, totals, ranks, max_values, slices)


def _slice(values: DataFrame, slices: int) -> tuple[list[float], np.ndarray]:
    """Slice limits, and how many rows each slice holds."""
    marks = values.approxQuantile("x", [i / slices for i in range(1, slices)], 0.5 / slices)
    edges = [-INFINITY, *_finite(marks), INFINITY]
    numbered = Bucketizer(splits=edges, inputCol="x", outputCol="slice").transform(values)
    totals = np.zeros(len(edges) - 1, dtype="int64")
    for place, n in numbered.groupBy("slice").agg(F.sum("n")).collect():
        totals[int(place)] = n
    return edges, totals


def _finite(marks: Sequence[float]) -> list[float]:
    """Inner limits for a bucketizer, which needs one; 0 when there are no values."""
    return sorted(set(marks) - {-INFINITY, INFINITY}) or [0.0]


def _within(low: float, high: float) -> Column:
    above = F.lit(True) if low == -INFINITY else F.col("x") >= low
    return above if high == INFINITY else above & (F.col("x") < high)


def _search(
    values: DataFrame,
    edges: list[float],
    totals: np.ndarray,
    ranks: Sequence[int],
    max_values: int,
    slices: int,
) -> list[float]:
    if not ranks:
        return []
    ends = np.cumsum(totals)
    home = np.searchsorted(ends, ranks)
    wanted = sorted(set(home.tolist()))
    within = {h: _within(edges[h], edges[h + 1]) for h in wanted}
    counts = values.where(reduce(or_, within.values())).groupBy("x").agg(F.sum("n").alias("n"))
    small = int(totals[wanted].sum()) <= max_values
    if not small:
        # Many rows, but perhaps few values: count them once, in files.
        counts = land(counts, "value-counts")
        small = counts.count() <= max_values
    table = counts.toArrow().sort_by("x") if small else None
    found = {}
    for h, inside in within.items():
        below = int(ends[h] - totals[h])
        local = [r - below for r in ranks if below < r <= ends[h]]
        if small:
            hits = _pick(table, edges[h], edges[h + 1], local)
        else:
            # One line per value from here on, so a hot value cannot keep the
            # slices from getting shorter.
            part = counts.where(inside)
            hits = _search(part, *_slice(part, slices), local, max_values, slices)
        found.update({r + below: hit for r, hit in zip(local, hits)})
    return [found[r] for r in ranks]


def _pick(table, low: float, high: float, ranks: Sequence[int]) -> list[float]:
    """Values at ranks counted from ``low``, in a table of values and row counts."""
    x, n = table["x"].to_numpy(), table["n"].to_numpy()
    first = np.searchsorted(x, low)
    stop = len(x) if high == INFINITY else np.searchsorted(x, high)
    running = np.cumsum(n[first:stop])
    return [float(x[first + np.searchsorted(running, r)]) for r in ranks]


def fit_bins(
    df: DataFrame,
    bins: dict[str, int],
    outputs: Sequence[str],
    relative_error: float = 0.001,
) -> Bucketizer:
    """A transformer from each column to the number of its quantile bin.

    Bins are closed on the left; equal cut points merge, giving fewer bins. A
    ``relative_error`` of 0 uses ``exact_quantiles``, which does not need the
    whole column in one place; otherwise Spark's quantile sketch is used.
    """
    return fit_bins_of_parts(df, [F.lit(True)], bins, outputs, relative_error)[0]


def fit_bins_of_parts(
    df: DataFrame,
    parts: Sequence[Column],
    bins: dict[str, int],
    outputs: Sequence[str],
    relative_error: float = 0.001,
) -> list[Bucketizer]:
    """Such a transformer for each part of ``df``, given as a condition.

    One pass builds the sketches of all parts and columns. Exact cut points are
    searched for each part and column, as many at once as there are columns.
    """
    if relative_error > 0:
        sketches = []
        for i, part in enumerate(parts):
            for column, groups in bins.items():
                value = F.col(column).cast("double")
                marks = F.array(*[F.lit(k / groups) for k in range(1, groups)])
                inside = F.when(part & ~F.isnan(value), value)
                sketches.append(
                    F.percentile_approx(inside, marks, math.ceil(1 / relative_error)).alias(f"{i}:{column}")
                )
        found = df.agg(*sketches).first() if sketches else {}
        cuts = [[found[f"{i}:{c}"] or [] for c in bins] for i in range(len(parts))]
    else:
        with ThreadPool(max(1, len(bins))) as pool:
            search = inheritable_thread_target(df.sparkSession)(
                lambda task: exact_quantiles(df.where(parts[task[0]]), task[1], bins[task[1]])
            )
            flat = pool.map(search, [(i, c) for i in range(len(parts)) for c in bins])
        cuts = [flat[i * len(bins) : (i + 1) * len(bins)] for i in range(len(parts))]
    return [
        Bucketizer(
            splitsArray=[[-INFINITY, *_finite(c), INFINITY] for c in of_part],
            inputCols=list(bins),
            outputCols=list(outputs),
        )
        for of_part in cuts
    ]


def cut_points(bucketizer: Bucketizer) -> dict[str, list[float]]:
    """The inner cut points of each column of a fitted transformer."""
    arrays = bucketizer.getSplitsArray()
    return {c: arrays[i][1:-1] for i, c in enumerate(bucketizer.getInputCols())}


def bin_counts(df: DataFrame, column: str, groups: int, relative_error: float = 0.0) -> DataFrame:
    """Rows per quantile bin, with the bin's lower cut point (null for the first)."""
    bucketizer = fit_bins(df.select(column), {column: groups}, ["bin"], relative_error)
    cuts = cut_points(bucketizer)[column]
    lower = F.element_at(F.array(F.lit(None).cast("double"), *map(F.lit, cuts)), F.col("bin") + 1)
    return (
        bucketizer.transform(df.select(column))
        .groupBy(F.col("bin").cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", lower.alias("lower_cut"), "n")
    )
