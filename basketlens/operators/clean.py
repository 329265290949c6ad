"""Typing, dropping incomplete purchases, and counting what was rejected."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.expressions import to_double, to_text, to_whole
from basketlens.schema import PURCHASE_SCHEMA, PurchaseColumns
from basketlens.sources.landing import land


def _typed(raw: DataFrame, columns: PurchaseColumns, price_type: str) -> dict[str, Column]:
    typed = {}
    for ours, source in columns.items():
        column, dtype = F.col(f"`{source}`"), raw.schema[source].dataType
        if ours == "age":
            typed[ours] = to_whole(column, dtype)
        elif ours == "unit_price":
            typed[ours] = to_double(column, dtype)
            if price_type != "double":
                typed[ours] = typed[ours].try_cast(price_type)
        else:
            typed[ours] = to_text(column, dtype)
    return typed


def parse(
    raw: DataFrame,
    columns: PurchaseColumns = PurchaseColumns(),
    keep: tuple[str, ...] = (),
    price_type: str = "double",
) -> DataFrame:
    """Our six columns with our types; a cell which cannot be read becomes null.

    ``price_type="float"`` stores the price in 32 bits, at the cost of visible
    rounding in averages.
    """
    typed = _typed(raw, columns, price_type)
    return raw.select(*keep, *[value.alias(name) for name, value in typed.items()])


def complete(names: list[str] | None = None) -> Column:
    """True when no purchase column is null and the price is a number.

    Written as plain null checks so that Parquet scans take them as filters.
    """
    names = names or PURCHASE_SCHEMA.fieldNames()
    present = [F.col(n).isNotNull() for n in names]
    if "unit_price" in names:
        present.append(~F.isnan("unit_price"))
    return reduce(lambda left, right: left & right, present)


def clean(
    raw: DataFrame,
    columns: PurchaseColumns = PurchaseColumns(),
    keep: tuple[str, ...] = (),
    price_type: str = "double",
) -> DataFrame:
    """Typed purchases with every row dropped that lacks one of the six values.

    Typing comes first, so that unreadable cells are dropped like missing ones.
    """
    return parse(raw, columns, keep, price_type).where(complete())


# What the counts are about: nothing in a cell, or something that can't be read.
_BAD = ("age", "unit_price")


def _reasons(columns: PurchaseColumns) -> dict[str, Column]:
    """Conditions of rejection by name; typed cells by our names, raw ones as ``__raw_...``."""
    reasons = {f"missing_{name}": F.col(f"__raw_{name}").isNull() for name, _ in columns.items()}
    for name in _BAD:
        unread = F.col(name).isNull() & F.col(f"__raw_{name}").isNotNull()
        nan = F.coalesce(F.isnan(name), F.lit(False)) if name == "unit_price" else F.lit(False)
        reasons[f"invalid_{name}"] = unread | nan
    return reasons


@dataclass(frozen=True)
class Cleaned:
    """What one pass over raw purchases leaves."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def clean_and_land(
    raw: DataFrame,
    columns: PurchaseColumns = PurchaseColumns(),
    keep: tuple[str, ...] = (),
    price_type: str = "double",
) -> Cleaned:
    """Complete purchases, rejected ones with their reasons, and the counts of both, from one scan.

    Every row is written once, rejected ones to a folder of their own with the
    cells as they came. The counts come from the written reasons alone, a column
    that takes next to no room. (Spark's ``Observation`` would give them with the
    write, but once a session has one, binary regressions of that session can no
    longer be sent to executors.) ``rows`` equals ``clean``, ``counts`` equals
    ``clean_counts``. ``rejects`` has the ``keep``
    columns, the six cells as text, and ``reasons``: names of the counts which the
    row went into. A name in ``keep`` that is also one of the six is not taken twice.
    """
    typed = _typed(raw, columns, price_type)
    keep = tuple(k for k in keep if k not in typed)
    cells = raw.select(
        *[F.col(f"`{k}`") for k in keep],
        *[value.alias(name) for name, value in typed.items()],
        *[F.col(f"`{source}`").cast("string").alias(f"__raw_{name}") for name, source in columns.items()],
    )
    reasons = _reasons(columns)
    named = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()]))
    marked = cells.withColumn("reasons", named).withColumn("rejected", F.size("reasons") > 0)
    # A kept row's raw cells say nothing that its typed ones don't.
    written = marked.withColumns({
        f"__raw_{name}": F.when(F.col("rejected"), F.col(f"__raw_{name}")) for name in typed
    })
    landed = land(written, "cleaned", partition_by=("rejected",))
    counts = landed.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.col("rejected")).alias("rows_kept"),
        *[F.count_if(F.array_contains("reasons", name)).alias(name) for name in reasons],
    )
    own = [F.col(f"`{k}`") for k in keep]
    return Cleaned(
        landed.where("NOT rejected").select(*own, *typed),
        landed.where("rejected").select(*own, *[F.col(f"__raw_{n}").alias(n) for n in typed], "reasons"),
        counts,
    )


def clean_counts(raw: DataFrame, columns: PurchaseColumns = PurchaseColumns()) -> DataFrame:
    """One row: rows in and kept, and per column how many cells were missing or bad."""
    typed = _typed(raw, columns, "double")
    pairs = raw.select(
        *[F.col(f"`{source}`").isNull().alias(f"{ours}_null") for ours, source in columns.items()],
        *[value.alias(ours) for ours, value in typed.items()],
    )
    missing = [
        F.count_if(F.col(f"{name}_null")).alias(f"missing_{name}") for name, _ in columns.items()
    ]
    bad_age = F.col("age").isNull() & ~F.col("age_null")
    bad_price = (F.col("unit_price").isNull() & ~F.col("unit_price_null")) | F.coalesce(
        F.isnan("unit_price"), F.lit(False)
    )
    return pairs.agg(
        F.count("*").alias("rows_in"),
        F.count_if(complete()).alias("rows_kept"),
        *missing,
        F.count_if(bad_age).alias("invalid_age"),
        F.count_if(bad_price).alias("invalid_unit_price"),
    )
