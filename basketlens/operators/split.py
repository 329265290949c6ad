"""Train/test split and folds which do not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.expressions import key_digest, key_hash
from basketlens.schema import SEED, SPLIT_WEIGHTS
from basketlens.sources.landing import land

# Hexadecimal digits of a digest, and how many of them one pass of a cut search reads.
DIGITS, STEP = 32, 3


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: int = SEED,
    names: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Add a ``split`` column drawn from a hash of the key columns.

    The key should identify a purchase: rows with equal keys go to the same part.
    """
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    digits, total, mark = key_hash(keys, seed), float(sum(weights)), 0.0
    chain = None
    for weight, name in zip(weights[:-1], names):
        mark += weight / total
        below = digits < F.lit(format(min(int(mark * 2**32), 2**32 - 1), "08x"))
        chain = F.when(below, name) if chain is None else chain.when(below, name)
    part = F.lit(names[-1]) if chain is None else chain.otherwise(F.lit(names[-1]))
    return df.withColumn("split", part)


def train_test_split(
    df: DataFrame,
    keys: Sequence[str] | None,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts; without a key, Spark's ``randomSplit`` decides."""
    if not keys:
        train, test = df.randomSplit(list(weights), seed=seed)
        return train, test
    marked = with_split(df, keys, weights, seed)
    return (
        marked.where("split = 'train'").drop("split"),
        marked.where("split = 'test'").drop("split"),
    )


def with_fold(df: DataFrame, keys: Sequence[str], folds: int, seed: int = SEED) -> DataFrame:
    """Add a ``fold`` number from 0 to ``folds - 1`` drawn from the same kind of hash.

    The seed is moved by one so that folds do not follow the split.
    """
    digits = key_hash(keys, seed + 1)
    return df.withColumn("fold", (F.conv(digits, 16, 10).cast("bigint") % folds).cast("int"))


def with_stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    strata: Sequence[str],
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: int = SEED,
    names: Sequence[str] = ("train", "test"),
) -> DataFrame:
    """Add a ``split`` column whose parts have their exact shares in every stratum.

    A stratum's rows are ordered by a digest of the key, and cut where the rounded
    share of its rows ends: each part is within one row of its share. Rows with
    equal keys stay together, so where keys repeat a part may be off by as many
    rows as share the key at the cut. A null is a stratum of its own.

    The cuts of all strata and parts are searched at once. A pass counts rows by
    stratum and the next ``STEP`` digits, combined before the shuffle, and looks
    only at rows in the stretch where a cut was found to lie; with distinct keys
    three passes do for strata of 10**10 rows. No task ever holds a stratum.
    """
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    shares, mark = [], 0.0
    for weight in weights[:-1]:
        mark += weight / float(sum(weights))
        shares.append(mark)
    # Nulls within a struct compare as equal.
    marked = df.withColumn("__stratum", F.struct(*[F.col(f"`{c}`") for c in strata]))
    marked = marked.withColumn("__digest", key_digest(keys, seed))
    part = F.lit(names[-1])
    if shares:
        cuts = _cuts(marked.select("__stratum", "__digest"), shares)
        # One line for each stratum.
        wide = cuts.groupBy("__stratum").agg(
            *[F.max(F.when(F.col("__part") == i, F.col("__cut"))).alias(f"__cut{i}") for i in range(len(shares))]
        )
        marked = marked.join(wide, "__stratum")
        for i in reversed(range(len(shares))):
            part = F.when(F.col("__digest") < F.col(f"__cut{i}"), names[i]).otherwise(part)
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], part.alias("split"))


def _cuts(rows: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(__stratum, __part, __cut): digests below ``__cut`` come before the end of part ``__part``."""
    one = ["__stratum", "__part"]

    def digits(level: int) -> Column:
        return F.substring("__digest", level + 1, STEP).alias("__next")

    parts = F.array(*[F.struct(F.lit(i).alias("__part"), F.lit(s).alias("__share")) for i, s in enumerate(shares)])
    first = land(rows.groupBy("__stratum", digits(0)).agg(F.count("*").alias("__n")), "cut-counts")
    sizes = first.groupBy("__stratum").agg(F.sum("__n").alias("__all")).select("__stratum", "__all", F.inline(parts))
    # ``__left`` rows behind the start of the stretch ``__prefix`` belong before the cut.
    searched = sizes.select(
        *one, F.lit("").alias("__prefix"), F.floor(F.col("__all") * F.col("__share") + 0.5).alias("__left")
    )
    settled = []
    for level in range(0, DIGITS, STEP):
        if level:
            near = rows.join(searched, "__stratum").where(F.substring("__digest", 1, level) == F.col("__prefix"))
            counts = near.groupBy(*one, "__prefix", "__left", digits(level)).agg(F.count("*").alias("__n"))
        else:
            counts = first.join(searched, "__stratum")
        # At most 16**STEP stretches for each stratum and part.
        order = Window.partitionBy(*one).orderBy("__next")
        counts = counts.withColumn("__before", F.sum("__n").over(order) - F.col("__n"))
        # The first stretch which reaches past the cut; none if the cut is behind all rows.
        past = F.col("__before") + F.col("__n") > F.col("__left")
        place = F.struct("__next", (F.col("__left") - F.col("__before")).alias("rest"), F.col("__n").alias("n"))
        steps = counts.groupBy(*one, "__prefix").agg(F.min(F.when(past, place)).alias("__at"))
        steps = land(steps, "cut-steps")
        start, rest = F.concat("__prefix", F.col("__at.__next")), F.col("__at.rest")
        last = F.lit(level + STEP >= DIGITS)
        # With no digits left a stretch is one key, which goes where most of its rows belong.
        behind = last & (2 * rest >= F.col("__at.n")) & (rest > 0)
        # "~" comes after all digits.
        cut = F.when(F.col("__at").isNull(), F.concat("__prefix", F.lit("~"))).otherwise(
            F.when(behind, F.concat(start, F.lit("~"))).otherwise(start)
        )
        done = F.col("__at").isNull() | (rest == 0) | last
        settled.append(steps.where(done).select(*one, cut.alias("__cut")))
        searched = steps.where(~done).select(*one, start.alias("__prefix"), rest.alias("__left"))
        if searched.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled)
