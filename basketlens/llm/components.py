"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.sources.landing import land

#: A key's rows are dealt to so many salts, and so to as many tasks.
SALTS = 64


def with_least(rows: DataFrame, key: str, value: str, spread: str, name: str = "m") -> DataFrame:
    """``rows`` with the least ``value`` among the rows of their key, as column ``name``.

    A key may hold any share of the rows: they are dealt by key and a salt taken
    from ``spread``, and the key's minimum is repeated only for the salts that it
    has, ``SALTS`` at most. Rows with a null key are left out.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    partial = salted.groupBy(key, "__salt").agg(F.min(value).alias(name))
    least = partial.groupBy(key).agg(F.min(name).alias(name), F.collect_list("__salt").alias("__salts"))
    copies = least.select(key, name, F.explode("__salts").alias("__salt"))
    return salted.join(copies, [key, "__salt"]).drop("__salt")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge but the roots; a root is its component's least node.

    ``edges`` has columns a and b. In each round every node first links its larger
    neighbours, then itself and its smaller neighbours, to the least node it
    knows. Both steps bring a node's minimum to its edges, with the edges of hot
    nodes spread over many tasks. Rounds are written to shared storage, and end
    when nothing changes: after about the logarithm of the longest path.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = land(pairs.distinct(), "edges")
    before, now = None, _state(current)
    while now != before and now[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        known = with_least(both, "a", "b", "b").where("b > a")
        large = known.select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = large.where("a <> b").distinct()
        # From here on a > b: the least of a's smaller neighbours takes a and the others.
        known = with_least(large, "a", "b", "b")
        small = known.select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        current = land(small.distinct(), "edges")
        before, now = now, _state(current)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
