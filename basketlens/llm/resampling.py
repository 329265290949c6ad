"""Importance resampling of documents towards a target corpus, by hashed n-grams.

Texts are read as bytes of UTF-8. One table of 256 bytes turns A-Z to lower case
and every separator to a blank; splitting at blanks then gives the words. A run of
words is a feature, its bucket a CRC-32 modulo ``BUCKETS``: the value of a run is
the seed from which the run with one more word goes on, so no run is ever put
together. Each task reduces its features to a counter of buckets, and these are
added up: what leaves a task is bounded by the number of buckets.

The gain of a bucket is the logarithm of its share in the target over its share in
the source, in thousandths. A document's weight is the mean gain of its features;
with Gumbel noise from a hash of its id, the highest scores are a draw without
replacement by importance. Texts are read twice, and never shuffled. Ranks come
from a sort by ranges of light rows, so no task holds all scores.

Defined cases: a null or empty text, or one of separators only, has no feature and
weight 0; a null id reads as the empty string in the hash and comes last among
ties; long texts are taken apart in pieces of ``PIECE`` bytes, with features
across their borders; repeated rows are documents each, and ties between rows of
one id go to fewer features, then to the lower weight, then to either of equal rows. Without documents
there are no rows; without target texts all buckets count 0 there. Columns but
doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.order import numbered
from basketlens.sources.landing import land

BUCKETS = 10_000
#: Words in the longest feature.
ORDER = 2
MIN_WORDS = 20
#: Documents drawn, in percent of those with enough words.
PERCENT = 25
SEED = 7
#: Bytes of a text that are taken apart at once.
PIECE = 1 << 20
#: Rows of a range of the final order, about.
RANGE_ROWS = 500_000


def _byte(b: int) -> int:
    if 65 <= b <= 90:
        return b + 32
    return b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32


TABLE = bytes(map(_byte, range(256)))


def runs(data: bytes, order: int = ORDER, piece: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """(n, values) for the runs of n words of a text, piece by piece: their CRC-32."""
    data = data.translate(TABLE)
    held: list[bytes] = []
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        words = held + data[at:end].split()
        values = list(map(crc32, words))
        for n in range(1, order + 1):
            if n > 1:
                values = list(map(crc32, words[n - 1 :], map(crc32, repeat(b" "), values)))
            # Runs inside what the piece before has left were given out with it.
            yield n, values[max(0, len(held) - n + 1) :]
        held = words[max(0, len(words) - order + 1) :]
        at = end


def feature_buckets(data: bytes, order: int = ORDER, buckets: int = BUCKETS) -> tuple[int, Counter[int]]:
    """How many words a text has, and how many features in each bucket."""
    n_words, counts = 0, Counter()
    for n, values in runs(data, order):
        if n == 1:
            n_words += len(values)
        counts.update(map(buckets.__rmod__, values))
    return n_words, counts


def bucket_counts(texts: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                for _, values in runs(data, order):
                    counts.update(map(buckets.__rmod__, values))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"]
        )

    data = texts.select(F.col(text).cast("binary").alias("data")).where("data IS NOT NULL")
    return data.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket, from two results of ``bucket_counts``.

    Both have at most ``buckets`` rows, which is what comes to the driver.
    """
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (source, target))
    s_all, t_all = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [
        math.floor(1000 * math.log(float(t.get(b, 0) + 1) * s_all / (float(s.get(b, 0) + 1) * t_all)))
        for b in range(buckets)
    ]


def weighted(docs: DataFrame, gain: list[int], order: int = ORDER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(1).to_pylist():
                n_words, counts = feature_buckets(data or b"", order, buckets)
                n = counts.total()
                rows.append((n_words, n, sum(gain[b] * k for b, k in counts.items()) // n if n else 0))
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``weights`` with the score: weight and noise from a hash of the seed and the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + noise)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
    order: int = ORDER, buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; rank is null if it isn't drawn."""
    gain = gains(bucket_counts(docs, order=order, buckets=buckets), bucket_counts(target, order=order, buckets=buckets))
    rows = land(scored(weighted(docs, gain, order), seed), "scored")
    enough = F.col("n_words") >= min_words
    eligible = rows.where(enough)
    n = eligible.count()
    taken = percent * n // 100
    best = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = numbered(eligible, best, "place", -(-n // RANGE_ROWS) or 1)
    drawn = ranked.withColumn("rank", F.when(F.col("place") < taken, F.col("place") + 1)).drop("place")
    return drawn.unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resampling_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).drop("n_words")


def crc32_sql(text: str) -> str:
    """DuckDB's expression for the unsigned CRC-32 of a text's bytes."""
    # Each byte is divided by the polynomial of CRC-32, lowest bit first.
    bit = "lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    return (
        f"xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda x: ('0x' || x)::BIGINT), "
        f"lambda c, b: list_reduce(range(8), {bit}, xor(c, b)), 4294967295), 4294967295)"
    )


def _grams_sql(name: str, table: str, key: str) -> str:
    """Features of a table's texts: its rows numbered, and one line for each feature."""
    words = (
        f"regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    pairs = "list_transform(range(1, len(w)::BIGINT), lambda i: w[i::INTEGER] || ' ' || w[i::INTEGER + 1])"
    return f"""{name}_w AS MATERIALIZED (SELECT {key}, row_number() OVER () AS row, coalesce({words}, []) AS w FROM {table}),
{name}_f AS MATERIALIZED (SELECT row, unnest(w || {pairs}) AS f FROM {name}_w)"""


RESAMPLING_SQL = f"""
WITH {_grams_sql("s", "documents", "doc_id")}, {_grams_sql("t", "benchmark", "item_id")},
codes AS MATERIALIZED (SELECT f, {crc32_sql("f")} % {BUCKETS} AS bucket
  FROM (SELECT f FROM s_f UNION SELECT f FROM t_f)),
s_b AS (SELECT bucket, count(*) AS n FROM s_f JOIN codes USING (f) GROUP BY bucket),
t_b AS (SELECT bucket, count(*) AS n FROM t_f JOIN codes USING (f) GROUP BY bucket),
gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln(
    (coalesce(t_b.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM s_f) + {BUCKETS})::DOUBLE
    / ((coalesce(s_b.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM t_f) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range({BUCKETS})) AS bucket) LEFT JOIN s_b USING (bucket) LEFT JOIN t_b USING (bucket)),
weights AS (SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM s_f JOIN codes USING (f) JOIN gain USING (bucket) GROUP BY row),
scores AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
  )))::BIGINT AS score FROM s_w LEFT JOIN weights USING (row)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS}
    ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
  count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS n FROM scores)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= {MIN_WORDS} AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM placed"""
