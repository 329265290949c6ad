"""The purchase table seen through the retail star schema of the test tables.

Gender, age and the rest are stand-ins: the tables hold no customer profile.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.clean import clean
from basketlens.operators.split import with_fold, with_split
from basketlens.schema import CV_FOLDS, PURCHASE_SCHEMA
from basketlens.sources.landing import land

KEY = "row_id"
#: Memory for the products that every executor gets, instead of shuffling the lines to them;
#: a product takes ``PRODUCT_BYTES`` and its category's text: two million of short ones fit.
PRODUCTS_BYTES, PRODUCT_BYTES = 100_000_000, 40
# By application and source folder, then by whether the copy has the key.
_LANDED: dict[tuple[str, str], dict[bool, DataFrame]] = {}
_LANDING = Lock()


def _row_id() -> Column:
    return F.md5(
        F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    ).alias(KEY)


def _joined(
    spark: SparkSession, sf_dir: str, own: Callable[[DataFrame], DataFrame], room: int
) -> DataFrame:
    """What ``own`` makes of each order line, with buyer and product looked up.

    A shuffled line costs what its columns take, so ``own`` should leave narrow ones:
    a flag for a text of two values. Buyer attributes are joined to the orders before
    the far larger line table is touched. Products of up to ``room`` bytes are broadcast,
    and the lines are shuffled once, by order; with more products, or where a negative
    ``spark.sql.autoBroadcastJoinThreshold`` forbids it, they may be shuffled by part
    before that. The other sides to broadcast are left to Spark, which goes by their size.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    buyers = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("o_orderkey", (F.col("c_acctbal") >= 5000).alias("member"), F.col("n_name").alias("province"))
    )
    products = table("part").select("p_partkey", F.col("p_type").alias("category"))
    if not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        size = F.lit(PRODUCT_BYTES) + F.coalesce(F.octet_length("category"), F.lit(0))
        if (products.agg(F.sum(size)).first()[0] or 0) <= room:
            products = F.broadcast(products)
    return (
        own(table("lineitem").withColumn("female", F.col("l_linestatus") == "F"))
        .join(products, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .withColumn("gender", F.when(F.col("female"), "female").when(F.col("female").isNotNull(), "male"))
        .withColumn("is_member", F.when(F.col("member"), "yes").when(F.col("member").isNotNull(), "no"))
    )


def order_lines(spark: SparkSession, sf_dir: str, room: int = PRODUCTS_BYTES) -> DataFrame:
    """One row per order line with buyer and product looked up.

    A line without a matching part, order, customer or nation keeps its row, with
    nulls, so that cleaning drops and counts it. The columns behind the key are
    narrower than the key, which is made after the joins.
    """
    return _joined(spark, sf_dir, lambda lines: lines, room).select(
        _row_id(),
        "gender",
        F.col("l_quantity").cast("int").alias("age"),
        "is_member",
        "category",
        "province",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        "l_discount",
        "l_tax",
    )


def _keyed(spark: SparkSession, sf_dir: str, room: int) -> DataFrame:
    rows = clean(order_lines(spark, sf_dir, room), keep=(KEY,))
    return with_fold(with_split(rows, [KEY]), [KEY], CV_FOLDS)


def _keyless(spark: SparkSession, sf_dir: str, room: int) -> DataFrame:
    """The same rows without the key: split and fold, all that is left of it, are taken before the joins."""

    def own(lines: DataFrame) -> DataFrame:
        placed = with_fold(with_split(lines.withColumn(KEY, _row_id()), [KEY]), [KEY], CV_FOLDS)
        return placed.select(
            "l_orderkey",
            "l_partkey",
            "female",
            F.col("l_quantity").cast("int").alias("age"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            (F.col("split") == "test").alias("test"),
            "fold",
        )

    rows = clean(_joined(spark, sf_dir, own, room), keep=("test", "fold"))
    split = F.when(F.col("test"), "test").otherwise("train").alias("split")
    return rows.select(*PURCHASE_SCHEMA.fieldNames(), split, "fold")


def purchases(spark: SparkSession, sf_dir: str, refresh: bool = False, keyed: bool = True) -> DataFrame:
    """Clean purchases, joined and written once per application and source folder.

    Every analysis then reads only the columns it needs from the landed table.
    Split and fold are stored too: both come from a hash of the key, which the
    passes of a model fit then need neither read nor compute. The key is most of a
    landed row and of a shuffled one: a copy without it (``keyed=False``) moves about
    half, and is made where only such are asked for. ``refresh`` reads
    the source again; callers in other threads wait for a copy that is being made.
    """
    slot = (spark.sparkContext.applicationId, sf_dir)
    with _LANDING:
        copies = {} if refresh else _LANDED.get(slot, {})
        found = copies.get(True) if keyed else copies.get(False, copies.get(True))
        if found is None:
            rows = (_keyed if keyed else _keyless)(spark, sf_dir, PRODUCTS_BYTES)
            found = land(rows, "purchases", compression="zstd")
            _LANDED[slot] = {**copies, keyed: found}
        return found


def dirty_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same purchases with unreadable ages, missing members and NaN prices."""
    lines = order_lines(spark, sf_dir)
    return lines.select(
        KEY,
        "gender",
        F.when(F.col("l_discount") == 0.1, "abc")
        .when(F.col("l_discount") == 0.09, F.lit(None))
        .otherwise(F.col("age").cast("string"))
        .alias("age"),
        F.when(F.col("l_tax") != 0.08, F.col("is_member")).alias("is_member"),
        "category",
        "province",
        F.when(F.col("l_tax") == 0.07, F.lit(float("nan")))
        .otherwise(F.col("unit_price"))
        .alias("unit_price"),
    )
