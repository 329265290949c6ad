"""Exact top-k search by inner product, in tiles.

Candidates are dealt to shards and queries to blocks, both by a hash of their id.
Each pair of a shard and a block is a tile: a task multiplies its matrices piece
by piece and keeps, for each query, the k best candidates of the tile. The lists
of a query are then merged in a tree, ``FAN`` at a time, until one is left. A
candidate is sent to as many tiles as there are blocks, a query to as many as
there are shards; with both of ``TILE`` rows, what is sent is as little as tiles
that fit in a task allow, and no task holds more than a tile.

Components are turned into whole numbers before, so that products are exact: in
single precision while every partial sum stays below 2**24, in double precision
below 2**53, with 64-bit integers below 2**62, and for the rare larger vectors of
a tile with integers of any size. A score whose absolute value is 2**62 or more
is ranked by its exact value, and shown as the nearest long if it is none.

Defined cases: vectors that are null or empty, or have null or non-finite (after scaling)
components, take no part, nor do rows with a null id. A query only meets candidates with as many components as
it has. A query's own row is any row with its id; equal rows (id and vector) are
one query, but as candidates each counts. Ties go to the smaller id. Queries
without candidates have no rows in the result.
"""

from __future__ import annotations

from heapq import nsmallest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a shard and of a block of queries.
TILE = 16_384
#: Rows multiplied at once within a tile.
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
FAN = 16
SCALE = 256
K = 5


def quantised(vectors: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): floor(scale * x) of each component, for the vectors that take part.

    Whole numbers as doubles, which are exact at any size.
    """

    def whole(x):
        y = F.lit(float(scale)) * x.cast("double")
        # A double of 2**53 or more has no fraction.
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)

    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) < float("inf")),
    )
    return vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(key).cast("long").alias("id"), F.transform(vector, whole).alias("v")
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers given as doubles."""
    n = a.shape[1]
    # Powers of two above every component, for bounds that can't overflow.
    tops = [np.frexp(np.abs(m).max(axis=1, initial=0))[1] for m in (a, b)]
    room = int(tops[0].max(initial=0)) + int(tops[1].max(initial=0)) + n.bit_length()
    if room <= 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if room <= 53:
        return (a @ b.T).astype(np.int64)
    if room <= 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    # Rows of which two always fit, and the rest.
    small = [t <= (62 - n.bit_length()) // 2 for t in tops]
    out = np.empty((len(a), len(b)), object)
    out[np.ix_(*small)] = a[small[0]].astype(np.int64) @ b[small[1]].astype(np.int64).T
    wide = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    out[~small[0]] = wide[0][~small[0]] @ wide[1].T
    out[np.ix_(small[0], ~small[1])] = wide[0][small[0]] @ wide[1][~small[1]].T
    return out


def _best(scores: np.ndarray, taken: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row, the places of the k largest scores that aren't taken; ties go to the left."""
    n = scores.shape[1]
    if scores.dtype == object:
        return [
            np.array(nsmallest(k, np.flatnonzero(~gone).tolist(), key=lambda p: (-row[p], p)), np.int64)
            for row, gone in zip(scores, taken)
        ]
    out = []
    if n > k and np.abs(scores).max(initial=0) < 2**62 // n - 1:
        # Score and place in one number, so that a partial selection settles ties.
        order = scores * n + np.arange(n)[::-1]
        order[taken] = np.iinfo(np.int64).min
        picked = np.argpartition(order, n - k, axis=1)[:, n - k :]
        picked = np.take_along_axis(picked, np.argsort(-np.take_along_axis(order, picked, 1), axis=1), 1)
        return [p[~t[p]] for p, t in zip(picked, taken)]
    for row, gone in zip(scores, taken):
        places = np.flatnonzero(~gone)
        out.append(places[np.lexsort((places, -row[places]))][:k])
    return out


#: Scores from here on are told apart by ``_beyond``.
LARGE = 2**62


def _beyond(score: int) -> str:
    """Empty for scores below ``LARGE``; for others a text that sorts larger scores first."""
    if abs(score) < LARGE:
        return ""
    digits = f"{abs(score):x}"
    text = f"{len(digits):04x}{digits}"
    if score < 0:
        return text
    return text.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def tile_best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of a tile for each of its queries."""
    found: dict[str, list] = {"query": [], "score": [], "id": []}
    q_width, c_width = (pc.list_value_length(t["v"]).to_numpy() for t in (queries, candidates))
    for width in np.unique(q_width):
        q = queries.filter(pa.array(q_width == width))
        c = candidates.filter(pa.array(c_width == width)).sort_by("id")
        if not c.num_rows:
            continue
        q_ids, c_ids = q["id"].to_numpy(), c["id"].to_numpy()
        numbers = q["query"].to_numpy()
        qm, cm = _matrix(q["v"], width), _matrix(c["v"], width)
        for a in range(0, len(q_ids), QUERY_ROWS):
            rows = slice(a, a + QUERY_ROWS)
            best: list[tuple[np.ndarray, np.ndarray]] = []
            for b in range(0, len(c_ids), CANDIDATE_ROWS):
                columns = slice(b, b + CANDIDATE_ROWS)
                scores = _products(qm[rows], cm[columns])
                own = q_ids[rows, None] == c_ids[None, columns]
                for i, places in enumerate(_best(scores, own, k)):
                    held = (scores[i, places], c_ids[columns][places])
                    if b:
                        # Earlier candidates have smaller ids: a stable sort settles ties.
                        held = tuple(map(np.concatenate, zip(best[i], held)))
                        top = np.argsort(-held[0], kind="stable")[:k]
                        best[i] = (held[0][top], held[1][top])
                    else:
                        best.append(held)
            for number, (s, ids) in zip(numbers[rows], best):
                found["query"].append(np.full(len(s), number))
                found["score"].append(s)
                found["id"].append(ids)
    scores = [int(s) for x in found.pop("score") for s in x]
    joined = {n: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for n, x in found.items()}
    return pa.table({
        **joined,
        "score": pa.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], pa.int64()),
        "minus": pa.array([-min(max(s, -LARGE), LARGE) for s in scores], pa.int64()),
        "beyond": pa.array([_beyond(s) for s in scores], pa.string()),
    })


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, tile: int = TILE) -> DataFrame:
    """(query_id, rank, id, score) for queries and candidates of columns (id, v)."""
    number = F.xxhash64("id", "v")
    queries = queries.dropDuplicates(["id", "v"]).withColumn("query", number)
    shards = max(1, -(-candidates.count() // tile))
    blocks = max(1, -(-queries.count() // tile))
    q = queries.select(
        "query", "id", "v", F.pmod("query", F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    # New names: a cogroup of two tables that share columns loses some of them.
    c = candidates.select(
        F.col("id").alias("cid"), F.col("v").alias("cv"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            shard = right["shard"][0].as_py()
            best = tile_best(left, right.select(["cid", "cv"]).rename_columns(["id", "v"]), k)
        else:
            numbers = {n: pa.array([], pa.int64()) for n in ("query", "score", "id", "minus")}
            shard, best = 0, pa.table({**numbers, "beyond": pa.array([], pa.string())})
        ids = dict(zip(left["query"].to_pylist(), left["id"].to_pylist())) if best.num_rows else {}
        named = pa.array([ids[x] for x in best["query"].to_pylist()], pa.int64())
        return pa.table({
            "query_id": named, "query": best["query"], "list": pa.array(np.full(best.num_rows, shard, np.int64)),
            "score": best["score"], "id": best["id"], "minus": best["minus"], "beyond": best["beyond"],
        })

    lists = (
        q.groupBy("shard", "block").cogroup(c.groupBy("shard", "block"))
        .applyInArrow(
            run,
            "query_id bigint, query bigint, list bigint, score bigint, id bigint, minus bigint, beyond string",
        )
    )
    left = shards
    while True:
        left = -(-left // FAN)
        entry = F.struct("minus", "beyond", "id", "score")
        merged = (
            lists.groupBy("query_id", "query", F.floor(F.col("list") / FAN).alias("list"))
            .agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
        )
        lists = merged.select("query_id", "query", "list", F.posexplode("best").alias("place", "x")).select(
            "query_id", "query", "list", "x.*", "place"
        )
        if left == 1:
            break
    return lists.select("query_id", (F.col("place") + 1).alias("rank"), "id", "score")


def topk_query(embeddings: DataFrame) -> DataFrame:
    vectors = quantised(embeddings)
    found = top_k(vectors.where(F.col("id") % 50 == 0), vectors)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


TOPK_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""
