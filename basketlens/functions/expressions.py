"""Built-in-only column expressions: safe casts, bands, shares, key hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_text(column: Column, dtype: T.DataType) -> Column:
    return column if isinstance(dtype, T.StringType) else column.cast("string")


def to_double(column: Column, dtype: T.DataType) -> Column:
    return column if isinstance(dtype, T.DoubleType) else column.try_cast("double")


def to_whole(column: Column, dtype: T.DataType) -> Column:
    """Integer value; text with a fraction is cut toward zero, bad text is null."""
    if isinstance(dtype, T.IntegerType):
        return column
    if isinstance(dtype, T.StringType):
        column = column.try_cast("double")
    return column.try_cast("int")


def band_labels(cuts: Sequence[int]) -> list[str]:
    """Half-open labels; the first band starts at 0 and the last is open."""
    edges = [0, *cuts]
    closed = [f"[{low},{high})" for low, high in zip(edges, edges[1:])]
    return [*closed, f"[{edges[-1]},inf)"]


def band(column: Column, cuts: Sequence[int]) -> Column:
    """The label of the band a value falls in; null stays null."""
    if list(cuts) != sorted(set(cuts)):
        raise ValueError("cut points must rise strictly")
    labels = band_labels(cuts)
    chain = F.when(column.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        chain = chain.when(column < cut, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part`` as a percentage of ``whole``; 0 when there is nothing to divide by."""
    value = F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """32 hex digits which depend on the key values and the seed only."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """The first eight of these digits."""
    return F.substring(key_digest(keys, seed), 1, 8)
