"""The given tables, and small pieces which several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space between words: the same characters for Java, RE2 and Python.
SPACE = r" \t\n\r\f\x0B"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    """Words between white space; 0 for a null or empty text."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")
