"""Token counts from an exact histogram of encoded lengths.

Each task encodes its texts and passes on how many have each length, so what is
shuffled follows the number of different lengths, not of documents. Suffix sums
over the histogram then answer, for every context limit: how many documents
reach it, how many tokens they hold, and what remains of the corpus if every
document is cut there. Prefix counts answer quantiles.

The sums are built in two steps, within spans of ``SPAN`` lengths and over the
spans, so no task holds the whole histogram.

The vocabulary is sent to the executors with the job, so that only the driver
needs the folder it lies in.

Defined cases: a null or empty text has length 0; a text of any length is encoded
whole, and one with very long runs of white space, on which the encoder's own
cutting fails, is cut around these runs with the same result; repeated rows count
as often as they occur; an empty table gives an empty histogram, limits of 0 and
null quantiles; other columns, and ids, are not read. Special tokens' strings
within a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.landing import land

TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
SPAN = 256

#: Context limits and shares of documents that the query answers for.
LIMITS = (512, 1024, 2048, 4096, 8192, 32_768)
SHARES = (0.5, 0.9, 0.99, 1.0)
#: White space in a row from which a text is cut around it; the encoder's stack ends at some 500,000.
LONG_RUN = 10_000

# Fixed value: white space as the pattern below understands it.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = re.compile(f"(?<![{SPACES}])[{SPACES}]{{{LONG_RUN},}}")

# Fixed value: the pattern which cuts a text before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-pair encoding whose ranks are in the file ``path``; read once in a process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encoded_length(text: str | None, path: str = RANKS) -> int:
    if not text:
        return 0
    encoding = encoder(path)
    total, at = 0, 0
    for run in _RUNS.finditer(text):
        # The pattern leaves a run's last space to what follows.
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def _shipped(df: DataFrame, ranks: str) -> str:
    """Send the vocabulary to the executors; the name under which tasks find it."""
    df.sparkSession.sparkContext.addFile(ranks)
    return os.path.basename(ranks)


def with_lengths(docs: DataFrame, name: str = "n_tokens", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``docs`` with the encoded length of every text."""
    file = _shipped(docs, ranks)

    @F.pandas_udf("bigint")
    def measured(texts: pd.Series) -> pd.Series:
        path = SparkFiles.get(file)
        return pd.Series([encoded_length(t, path) for t in texts], dtype="int64")

    return docs.withColumn(name, measured(F.col(text)))


def length_histogram(docs: DataFrame, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(length, n_docs): how many documents have each encoded length."""
    file = _shipped(docs, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(file)
        counts: Counter[int] = Counter()
        for batch in batches:
            counts.update(encoded_length(t, path) for t in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["length", "n_docs"],
        )

    counted = docs.select(text).mapInArrow(run, "length bigint, n_docs bigint")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit, what reaches it and what is cut.

    length, n_docs, docs_at_least, tokens_at_least, docs_up_to, truncated_total:
    ``truncated_total`` is the number of tokens left when every document keeps its
    first ``length`` tokens.
    """
    # It is read twice below, and the texts are to be encoded once.
    rows = land(histogram, "histogram").select(
        "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("length") / SPAN).alias("span"),
    )
    spans = rows.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    everything = W.partitionBy()
    down = W.orderBy(F.col("span").desc())
    above = spans.select(
        "span",
        (F.sum("d").over(down) - F.col("d")).alias("docs_above"),
        (F.sum("t").over(down) - F.col("t")).alias("tokens_above"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    within = W.partitionBy("span").orderBy(F.col("length").desc())
    joined = rows.join(above, "span").select(
        "length", "n_docs", "all_docs", "all_tokens",
        (F.sum("n_docs").over(within) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum("tokens").over(within) + F.col("tokens_above")).alias("tokens_at_least"),
    )
    return joined.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, docs_at_least, tokens_at_least, truncated_total) for any limits, in one pass.

    The answer for a limit follows from the next length that occurs.
    """
    lines = []
    for limit in limits:
        reach = F.col("length") >= limit
        docs = F.coalesce(F.max(F.when(reach, F.col("docs_at_least"))), F.lit(0))
        tokens = F.coalesce(F.max(F.when(reach, F.col("tokens_at_least"))), F.lit(0))
        total = F.coalesce(F.max("tokens_at_least"), F.lit(0))
        lines.append(F.struct(
            F.lit(limit).cast("long").alias("limit"), docs.alias("docs_at_least"),
            tokens.alias("tokens_at_least"), (total - tokens + limit * docs).alias("truncated_total"),
        ))
    return sums.agg(F.array(*lines).alias("x")).select(F.inline("x"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the shortest length that this share of all documents doesn't exceed.

    Null lengths when there are no documents.
    """
    n = F.max("docs_up_to")
    totals = sums.agg(n.alias("n"))
    lines = [
        F.struct(F.lit(float(q)).alias("share"), F.greatest(F.ceil(F.col("n") * F.lit(float(q))), F.lit(1)).alias("rank"))
        for q in shares
    ]
    ranks = totals.select(F.inline(F.array(*lines)))
    # As many lines as shares, so this side is small by construction.
    return (
        ranks.join(sums.select("length", "docs_up_to"), F.col("docs_up_to") >= F.col("rank"), "left")
        .groupBy("share").agg(F.min("length").alias("length"))
    )


def lengths_query(docs: DataFrame) -> DataFrame:
    """The suffix sums at every length that occurs, at the standard limits, and the quantiles.

    ``kind`` is length, limit or quantile; a quantile's line has its share of the
    documents and its length.
    """
    sums = land(suffix_sums(length_histogram(docs)), "suffix-sums")
    limits = at_limits(sums, LIMITS).withColumnRenamed("limit", "length")
    result = sums.withColumn("kind", F.lit("length")).withColumn("share", F.lit(None).cast("double"))
    result = result.unionByName(limits.withColumn("kind", F.lit("limit")), allowMissingColumns=True)
    return result.unionByName(quantiles(sums, SHARES).withColumn("kind", F.lit("quantile")), allowMissingColumns=True)
