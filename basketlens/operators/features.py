"""Feature stages: category numbers, quantile bins, one-hot vectors, cells.

Every feature takes one of few values, so purchases with equal features are
counted into *cells* before any model sees them. Three passes follow the number
of purchases: one for the value lists, one for the quantile sketches (exact cut
points take three), one for the cells. The first two serve any number of
training sets at once. Selection, training and scoring work on cells with a weight.
"""

from __future__ import annotations

from collections.abc import Hashable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.profile import group_counts
from basketlens.operators.quantiles import fit_bins_of_parts
from basketlens.schema import AGE_BINS, PRICE_BINS
from basketlens.sources.landing import land

#: Values that a sketch of frequent values holds at least.
SKETCH = 10_000
#: Values which one task numbers.
RANGE_VALUES = 200_000


@dataclass(frozen=True)
class FeatureSpec:
    """What goes into the feature vector, and how.

    ``unseen="keep"`` gives values not met in training a slot of their own, which
    the encoder then drops: every known value has a slot. ``unseen="error"``
    rejects them, and the least frequent known value has no slot.
    ``max_categories`` bounds each value list; having more is an error. With
    ``fold_rare`` the rarer values of a feature column count as unseen instead
    (only under ``"keep"``, never for the label), and the fitted model says how
    many purchases that are.

    ``unseen="hash"`` takes a feature column with any number of values. A sketch
    of frequent values, merged over the tasks, finds the up to ``max_categories``
    less ``hash_slots`` values that keep a slot; where others are left, they and
    values not met in training share ``hash_slots`` slots by a hash of the value.
    Where every value has a slot the result is that of ``"keep"``.
    """

    categorical: tuple[str, ...] = ("gender", "is_member", "province")
    bins: dict[str, int] = field(
        default_factory=lambda: {"age": AGE_BINS, "unit_price": PRICE_BINS}
    )
    label: str = "category"
    unseen: str = "keep"
    relative_error: float = 0.001
    max_categories: int = 10_000
    fold_rare: bool = False
    hash_slots: int = 64


@dataclass(frozen=True)
class Slot:
    """One position of the feature vector."""

    number: int
    feature: str
    source_column: str
    # The category number behind a one-hot position; None for a bin number.
    value_index: int | None


@dataclass(frozen=True)
class FeatureModel:
    spec: FeatureSpec
    labels: list[str]
    indexers: list[StringIndexerModel]
    bucketizer: Bucketizer
    encoder: OneHotEncoderModel
    assembler: VectorAssembler
    slots: list[Slot]
    # Training purchases whose value was too rare for the list, by column.
    folded: dict[str, int] = field(default_factory=dict)
    # Names of the slots, own and shared, of columns with shared slots.
    hashed: dict[str, list[str]] = field(default_factory=dict)
    hashers: list[SQLTransformer] = field(default_factory=list)

    @property
    def label_indexer(self) -> StringIndexerModel:
        """Unseen labels get the number after the last known one."""
        return StringIndexerModel.from_labels(
            self.labels, inputCol=self.spec.label, outputCol="label", handleInvalid="keep"
        )

    @property
    def index_columns(self) -> list[str]:
        return [f"{c}_index" for c in self.indexed]

    @property
    def indexed(self) -> list[str]:
        """The categorical columns which have slots."""
        bins = self.spec.bins
        return list(dict.fromkeys(s.source_column for s in self.slots if s.source_column not in bins))

    @property
    def bin_columns(self) -> list[str]:
        return list(self.bucketizer.getOutputCols())

    @property
    def number_stages(self) -> list:
        return [*self.indexers, *self.hashers, self.bucketizer]

    @property
    def stages(self) -> list:
        return [*self.number_stages, self.encoder, self.assembler]

    def transform(self, df: DataFrame) -> DataFrame:
        """Purchases with their ``features`` vector, row by row."""
        return PipelineModel(stages=self.stages).transform(df)

    def vectors(self, cells: DataFrame) -> DataFrame:
        """Cells with their ``features`` vector."""
        return self.assembler.transform(self.encoder.transform(cells))


def value_index(df: DataFrame, column: str) -> DataFrame:
    """The number which label encoding gives each value: 0 for the most frequent.

    Ties are numbered by name. The table of values is dealt to ranges of that
    order, of about ``RANGE_VALUES``, and numbered within each; the sizes of the
    ranges before it give where a range starts. So no task holds all values, however
    many there are.
    """
    present = df.select(column).where(F.col(column).isNotNull())
    order = [F.desc("n"), F.asc(column)]
    counts = land(group_counts(present, column), "value-counts")
    ranges = -(-counts.count() // RANGE_VALUES)
    if ranges <= 1:
        number = (F.row_number().over(Window.orderBy(*order)) - 1).cast("int")
        return counts.select(column, "n", number.alias("index"))
    dealt = land(
        counts.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "value-ranges"
    )
    # One line for each range.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("range").agg(F.count("*").alias("m")).select(
        "range", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start")
    )
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    numbered = dealt.withColumn("within", within).join(starts, "range")
    return numbered.select(column, "n", (F.col("start") + F.col("within")).cast("int").alias("index"))


def _value_lists(
    df: DataFrame, columns: list[str], parts: list[Column], at_most: int
) -> list[dict[str, list[tuple[str, int]]]]:
    """For each part, the values and counts of each column from the most frequent on.

    One pass counts all columns and parts. Of each list ``at_most`` values and one
    more are used, and the total under the value None. If all lists together are no
    longer than that they come to the driver at once, else cut for each part.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    inside = [F.coalesce(p, F.lit(False)).cast("int").alias(f"part{i}") for i, p in enumerate(parts)]
    sums = [F.sum(f"part{i}").alias(f"n{i}") for i in range(len(parts))]
    counted = df.select(*inside, F.inline(pairs)).where("value IS NOT NULL")
    counted = land(counted.groupBy("column", "value").agg(*sums), "value-counts")
    most = len(columns) * (at_most + 1)
    few = counted.limit(most + 1).collect()
    lists = []
    for i in range(len(parts)):
        n = f"n{i}"
        totals = {c: 0 for c in columns}
        found: dict[str, list[tuple]] = {c: [] for c in columns}
        if len(few) <= most:
            rows = [(r["column"], r["value"], r[n]) for r in few if r[n]]
            for column, _, count in rows:
                totals[column] += count
        else:
            tops = [
                counted.where((F.col("column") == c) & (F.col(n) > 0))
                .select("column", "value", n).orderBy(F.desc(n), "value").limit(at_most + 1)
                for c in columns
            ]
            rows = [tuple(r) for r in reduce(DataFrame.unionAll, tops).collect()]
            totals |= dict(map(tuple, counted.groupBy("column").agg(F.sum(n)).collect()))
        for column, value, count in sorted(rows, key=lambda r: (-r[2], r[1].encode())):
            found[column].append((value, count))
        lists.append({c: [*v[: at_most + 1], (None, totals[c])] for c, v in found.items()})
    return lists


def _frequent_values(
    df: DataFrame, columns: list[str], parts: list[Column], own: int
) -> list[dict[str, tuple[list[tuple[str, int]], int, bool]]]:
    """For each part and column: frequent values with counts, the total, and whether these are all.

    One pass builds a sketch of frequent items for each part and column; only
    sketches are shuffled. Counts are exact while a column has no more values than
    a sketch holds, ``SKETCH`` or four times ``own``. A sketch of over ``2 * own``
    items that ever dropped some overstates its counts so much that at most ``own``
    of them can't add up to the total: so equal sums tell that these are all values.
    """
    inside = [F.coalesce(p, F.lit(False)).alias(f"__part{i}") for i, p in enumerate(parts)]
    rows = df.select(*inside, *[F.col(c).cast("string").alias(c) for c in columns])
    tracked = max(SKETCH, 4 * own)
    found = rows.agg(*[
        F.struct(
            F.expr(f"approx_top_k(`{c}`, {own + 1}, {tracked}) FILTER (WHERE __part{i} AND `{c}` IS NOT NULL)").alias("items"),
            F.count_if(F.col(f"__part{i}") & F.col(f"`{c}`").isNotNull()).alias("total"),
        ).alias(f"{i} {c}")
        for i in range(len(parts)) for c in columns
    ]).first()
    lists = []
    for i in range(len(parts)):
        part = {}
        for c in columns:
            items, total = found[f"{i} {c}"]["items"] or [], found[f"{i} {c}"]["total"]
            pairs = sorted(((x["item"], x["count"]) for x in items), key=lambda x: (-x[1], x[0].encode()))
            complete = len(pairs) <= own and sum(n for _, n in pairs) == total
            part[c] = (pairs[:own], total, complete)
        lists.append(part)
    return lists


def _hasher(column: str, known: int, shared: int) -> SQLTransformer:
    """Numbers behind the ``known`` ones for the other values of a column; nulls come last."""
    place = f"{known} + conv(substring(md5(CAST(`{column}` AS STRING)), 1, 8), 16, 10) % {shared}"
    own = f"WHEN `{column}_known` < {known} THEN `{column}_known`" if known else ""
    return SQLTransformer(statement=(
        f"SELECT *, CAST(CASE WHEN `{column}` IS NULL THEN {known + shared} {own} ELSE {place} END AS DOUBLE) "
        f"AS `{column}_index` FROM __THIS__"
    ))


def fit_features(train: DataFrame, spec: FeatureSpec = FeatureSpec()) -> FeatureModel:
    """Learn value lists, cut points and the vector layout from ``train``."""
    return fit_feature_models(train, {"all": F.lit(True)}, spec)["all"]


def fit_feature_models(
    df: DataFrame, parts: dict[Hashable, Column], spec: FeatureSpec = FeatureSpec()
) -> dict[Hashable, FeatureModel]:
    """A model for each part of the purchases, given as a condition; in two passes for all.

    Exact cut points (``relative_error`` 0) take passes of their own for each part.
    """
    listed = [spec.label] if spec.unseen == "hash" else [spec.label, *spec.categorical]
    lists = _value_lists(df, listed, list(parts.values()), spec.max_categories)
    frequent = [{}] * len(parts)
    if spec.unseen == "hash":
        if not 0 < spec.hash_slots < spec.max_categories:
            raise ValueError("hash_slots must be positive and below max_categories")
        own = spec.max_categories - spec.hash_slots
        frequent = _frequent_values(df, list(spec.categorical), list(parts.values()), own)
    bin_names = [f"{c}_bin" for c in spec.bins]
    bucketizers = fit_bins_of_parts(df, list(parts.values()), spec.bins, bin_names, spec.relative_error)
    return {
        name: _feature_model(df, spec, values, bucketizer, most)
        for name, values, bucketizer, most in zip(parts, lists, bucketizers, frequent)
    }


def _feature_model(
    df: DataFrame,
    spec: FeatureSpec,
    counted: dict[str, list[tuple]],
    bucketizer: Bucketizer,
    frequent: dict[str, tuple],
) -> FeatureModel:
    values, folded, hashed = {}, {}, {}
    for column, pairs in counted.items():
        known, total = pairs[:-1], pairs[-1][1]
        if len(known) > spec.max_categories:
            if not spec.fold_rare or spec.unseen != "keep" or column == spec.label:
                raise ValueError(f"{column} has over {spec.max_categories} values")
            known = known[: spec.max_categories]
            folded[column] = total - sum(n for _, n in known)
        values[column] = [v for v, _ in known]
    for column, (pairs, total, complete) in frequent.items():
        values[column] = [v for v, _ in pairs]
        if not complete:
            hashed[column] = [*values[column], *[f"#{i}" for i in range(spec.hash_slots)]]
            folded[column] = max(0, total - sum(n for _, n in pairs))
    # A single value carries no information, and the encoder does not take it.
    used = [c for c in spec.categorical if len(values[c]) > 1 or c in hashed]
    # One stage per column: PySpark pads label lists of unequal length with nulls.
    indexers = [
        StringIndexerModel.from_labels(
            values[c], inputCol=c, outputCol=f"{c}_known" if c in hashed else f"{c}_index",
            handleInvalid="keep" if spec.unseen == "hash" else spec.unseen,
        )
        for c in used if values[c]
    ]
    hashers = [_hasher(c, len(values[c]), spec.hash_slots) for c in used if c in hashed]
    bin_names = [f"{c}_bin" for c in spec.bins]
    indexed = _named(PipelineModel(stages=[*indexers, *hashers, bucketizer]).transform(df), hashed)
    # The encoder takes its sizes from column metadata: no job runs.
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in used], outputCols=[f"{c}_vec" for c in used]
    ).fit(indexed)
    assembler = VectorAssembler(
        inputCols=[f"{c}_vec" for c in used] + bin_names, outputCol="features"
    )
    layout = assembler.transform(encoder.transform(indexed)).schema
    slots = _slots(layout, used, list(spec.bins))
    return FeatureModel(
        spec, values[spec.label], indexers, bucketizer, encoder, assembler, slots, folded, hashed, hashers
    )


def _named(numbered: DataFrame, hashed: dict[str, list[str]]) -> DataFrame:
    """Numbers of columns with shared slots, with the slots' names for the encoder; null's place is the last."""
    for column, names in hashed.items():
        nominal = {"ml_attr": {"type": "nominal", "name": f"{column}_index", "vals": [*names, "__unknown"]}}
        numbered = numbered.withMetadata(f"{column}_index", nominal)
    return numbered


def _slots(layout, categorical: list[str], binned: list[str]) -> list[Slot]:
    """Slot names from the metadata which the assembler leaves on its column."""
    groups = layout["features"].metadata["ml_attr"]["attrs"].values()
    names = {a["idx"]: a["name"] for group in groups for a in group}
    sources: list[tuple[str, int | None]] = []
    for column in categorical:
        size = layout[f"{column}_vec"].metadata["ml_attr"]
        width = size.get("num_attrs") or sum(len(g) for g in size["attrs"].values())
        sources += [(column, i) for i in range(width)]
    sources += [(column, None) for column in binned]
    slots = []
    for number, (column, index) in enumerate(sources):
        part = f"{column}_vec_" if index is not None else f"{column}_bin"
        value = names[number].removeprefix(part)
        slots.append(Slot(number, f"{column}={value}" if value else column, column, index))
    return slots


def cells(df: DataFrame, model: FeatureModel, *also_by: str) -> DataFrame:
    """Purchases counted by feature numbers, label and the ``also_by`` columns.

    The result is landed: its size depends on the number of distinct feature
    combinations, and everything after it reads it many times.
    """
    numbers = PipelineModel(stages=[model.label_indexer, *model.number_stages])
    numbered = _named(numbers.transform(df), model.hashed)
    by = [*also_by, *model.index_columns, *model.bin_columns, "label"]
    return land(numbered.groupBy(*by).agg(F.count("*").alias("n")), "cells")


def nonzero_entries(df: DataFrame, model: FeatureModel, key: str) -> DataFrame:
    """The feature matrix in long form: ``(key, slot, value)`` for non-zero entries."""
    numbered = PipelineModel(stages=model.number_stages).transform(df)
    first: dict[str, int] = {}
    width: dict[str, int] = {}
    for slot in model.slots:
        first.setdefault(slot.source_column, slot.number)
        width[slot.source_column] = width.get(slot.source_column, 0) + 1
    entries = []
    for column, start in first.items():
        if column in model.spec.bins:
            number = F.col(f"{column}_bin")
            entries.append((number != 0, F.lit(start), number))
        else:
            number = F.col(f"{column}_index")
            entries.append((number < width[column], number.cast("int") + start, F.lit(1.0)))
    listed = F.array(
        *[
            F.when(present, F.struct(slot.cast("int").alias("slot"), value.alias("value")))
            for present, slot, value in entries
        ]
    )
    return numbered.select(key, F.inline(F.array_compact(listed)))
