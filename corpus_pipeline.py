"""A corpus pipeline: quality, near duplicates, secrets, mixture, packing.

Each stage takes the session, the documents that the stage before it kept, and the
folder of the given tables. All but the last return documents with the columns
they came with. What becomes of nulls, empty and very long texts, ties, repeated
rows, empty tables and columns of clashing names is said in the module of the
operator that a stage calls. Tokens are those of the public byte-pair vocabulary
that ``lengths`` names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import lengths, mixing, ngram_join, packing, quality, secrets
from basketlens.llm.tables import table
from basketlens.sources.landing import land

# A document is taken once at most, so that no copies come back after their removal.
MIX_EPOCHS = 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents which the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by the name of their kind.

    ``n_chars``, where there is one, follows the new text.
    """
    clean = secrets.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen so that domains, languages and sources have their target shares of tokens."""
    names = docs.columns
    placed = docs.select(*[F.col(f"`{n}`") for n in names], mixing.domain_of(F.col("source")).alias("__domain"))
    # Read several times, and the texts are to be encoded once.
    counted = land(lengths.with_lengths(placed, "__tokens"), "counted")
    levels = ("__domain", "lang", "source")
    weights = {"__domain" if k == "domain" else k: v for k, v in mixing.WEIGHTS.items()}
    chosen = mixing.mix(counted, levels, "__tokens", epochs=MIX_EPOCHS, weights=weights, epoch_name="__epoch")
    return chosen.select(*[F.col(f"`{n}`") for n in names])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.packing_query(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# Nearest neighbours and greedy packing have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = land(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
