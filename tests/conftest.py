from __future__ import annotations

import random

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("basketlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SCHEMA = (
    "row_id string, gender string, age int, is_member string, category string, "
    "province string, unit_price double"
)


@pytest.fixture(scope="session")
def planted(spark):
    """Purchases whose category follows gender and age, with 10 % noise."""
    source = random.Random(7)
    names = ["books", "food", "sport", "toys"]
    rows = []
    for i in range(4000):
        gender = source.choice(["female", "male"])
        age = source.randint(15, 64)
        category = names[(gender == "male") * 2 + (age >= 40)]
        if source.random() < 0.1:
            category = source.choice(names)
        rows.append(
            (
                f"r{i}",
                gender,
                age,
                source.choice(["yes", "no", "no"]),
                category,
                f"P{min(source.randint(0, 9), source.randint(0, 9))}",
                round(source.uniform(1, 100), 2),
            )
        )
    return spark.createDataFrame(rows, SCHEMA).repartition(4, "row_id").cache()
