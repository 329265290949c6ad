"""The operators applied to the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import (
    chat,
    fingerprints,
    lengths,
    mixing,
    ngram_join,
    packing,
    quality,
    repair,
    resampling,
    secrets,
    topk,
    url_filter,
    warc,
)
from basketlens.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk_query(table(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_query(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_query(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_query(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_query(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_query(table(spark, sf_dir, "conversations"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_query(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_query(table(spark, sf_dir, "documents"))


def op9_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.lengths_query(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_query(table(spark, sf_dir, "conversations"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampling_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter_query(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_chat": op6_chat,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_lengths": op9_lengths,
    "op10_quality": op10_quality,
    "op11_repair": op11_repair,
    "op12_resampling": op12_resampling,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op1_topk": topk.TOPK_SQL,
    "op2_ngram_jaccard_join": ngram_join.JOIN_SQL,
    "op3_warc": warc.WARC_SQL,
    "op4_mixing": mixing.mixing_sql(),
    "op5_secrets": secrets.secrets_sql(),
    "op6_chat": chat.CHAT_SQL,
    "op11_repair": repair.REPAIR_SQL,
    "op12_resampling": resampling.RESAMPLING_SQL,
    "op13_url_filter": url_filter.URL_FILTER_SQL,
}
