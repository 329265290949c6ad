"""The purchase row: column names, values with a meaning, and types."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import types as T


@dataclass(frozen=True)
class PurchaseColumns:
    """Maps our six column names to the names used by a source table."""

    gender: str = "gender"
    age: str = "age"
    is_member: str = "is_member"
    category: str = "category"
    province: str = "province"
    unit_price: str = "unit_price"

    def items(self) -> list[tuple[str, str]]:
        """``(our name, source name)`` pairs in declaration order."""
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


@dataclass(frozen=True)
class PurchaseValues:
    """The values which mean "female" and "is a member" in the data."""

    female: str = "female"
    member: str = "yes"


# Headers and cell values of the Chinese-language purchase export.
CHINESE_COLUMNS = PurchaseColumns(
    gender="性别",
    age="年龄",
    is_member="是否会员",
    category="商品大类",
    province="收货省份",
    unit_price="单价",
)
CHINESE_VALUES = PurchaseValues(female="女", member="是")

# Age-band cut points, train/test weights, seed, bin and feature
# counts, forest and regression settings.
AGE_CUTS = (25, 35, 45)
SPLIT_WEIGHTS = (0.7, 0.3)
SEED = 42
AGE_BINS = 4
PRICE_BINS = 5
HISTOGRAM_BINS = 20
TOP_PROVINCES = 10
TOP_FEATURES = 10
FOREST_TREES = 100
FOREST_DEPTH = 8
REGRESSION_ITERATIONS = 100
REGRESSION_PENALTY = 0.1
CV_FOLDS = 3

PURCHASE_SCHEMA = T.StructType(
    [
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("is_member", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
    ]
)
