"""Best-fit packing into bins of several permitted lengths.

Documents longer than the longest length are cut: full bins first, then a rest.
Rests are dealt by a hash into shards of bounded size, and each shard is packed
on its own by best fit in decreasing order of length. A piece goes to the open
bin with the least room that still takes it. If there is none, a bin opens: of
the permitted lengths that take the piece, the one whose cost for each token that
it can still be filled with is least. At the end every bin shrinks to the
shortest permitted length that holds its contents.

The cost of a sequence of n places is ``overhead + n + n * n * quadratic``: a
fixed share, a linear share, and attention.

Defined cases: a document without tokens (null or empty text, or a null count)
keeps a row, with piece 0, length 0 and no bin; a text of any length, with or
without spaces, is cut by its tokens; repeated rows are packed as often as they
occur; rows with a null id are packed like others; pieces of equal length go by id
(null last) and number; an empty table gives an empty result. Columns but the key
and the count are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.lengths import with_lengths
from basketlens.sources.landing import land

#: Permitted sequence lengths.
CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces that a shard should hold; a shard leaves a few bins unfilled at most.
SHARD_PIECES = 32_768


def cost(length: int, overhead: float = 64.0, quadratic: float = 1 / 16384) -> float:
    return overhead + length + quadratic * length * length


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and start of each piece, and each bin's length; pieces come in decreasing length."""
    room_heads: list[int] = []  # the rooms that open bins have, sorted
    by_room: dict[int, list[int]] = {}
    room: list[int] = []
    opened: list[int] = []
    n = len(lengths)
    bins, starts = np.empty(n, np.int64), np.empty(n, np.int64)
    left = int(lengths.sum())

    def put(b: int) -> None:
        if room[b]:
            if room[b] not in by_room:
                by_room[room[b]] = []
                insort(room_heads, room[b])
            by_room[room[b]].append(b)

    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(room_heads, length)
        if at < len(room_heads):
            key = room_heads[at]
            b = by_room[key].pop()
            if not by_room[key]:
                del by_room[key], room_heads[at]
        else:
            b = len(opened)
            fits = [c for c in capacities if c >= length]
            opened.append(min(fits, key=lambda c: (cost(c) / min(c, left), c)))
            room.append(opened[b])
        bins[i], starts[i] = b, opened[b] - room[b]
        room[b] -= length
        left -= length
        put(b)
    held = np.asarray(opened, np.int64) - np.asarray(room, np.int64)
    sizes = np.asarray(sorted(capacities), np.int64)
    return bins, starts, sizes[np.searchsorted(sizes, held)]


def best_fit(docs: DataFrame, length: str, key: str = "doc_id", capacities: tuple[int, ...] = CAPACITIES,
             shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """A row for each piece: key, piece, start, length, bin, capacity and place in the bin.

    ``start`` is the piece's first token in its document. Bins are named by shard
    and number. The number of shards follows the number of rows; which shard a rest
    goes to follows from its key, length and number among equal rows. Full pieces
    take no part in the shards.
    """
    capacities = tuple(sorted(capacities))
    longest = capacities[-1]
    counted = docs.select(
        F.col(key).alias("key"), F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long").alias("n")
    )
    shards = max(1, -(-counted.count() // shard_pieces))
    # Repeated rows get a number each, so that they do not all fall into one shard.
    copies = counted.groupBy("key", "n").agg(F.count("*").alias("copies"))
    rows = copies.select("key", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    full, rest = F.floor(F.col("n") / longest), F.col("n") % longest
    name = F.coalesce(F.col("key").cast("string"), F.lit("null"))
    cut = (
        rows.where(full > 0)
        .select("key", "copy", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"))
        .select(
            "key", "piece", (F.col("piece") * longest).alias("start"), F.lit(longest).cast("long").alias("length"),
            F.concat_ws("-", F.lit("full"), name, "copy", "piece").alias("bin"),
            F.lit(longest).cast("long").alias("capacity"), F.lit(0).cast("long").alias("place"),
        )
    )
    none = rows.where("n = 0").select(
        "key", *[F.lit(0).cast("long").alias(c) for c in ("piece", "start", "length")],
        F.lit(None).cast("string").alias("bin"), *[F.lit(None).cast("long").alias(c) for c in ("capacity", "place")],
    )
    rests = rows.where(rest > 0).select(
        "key", full.alias("piece"), (full * longest).alias("start"), rest.alias("length"),
        F.pmod(F.xxhash64(name, "n", "copy"), F.lit(shards)).cast("int").alias("shard"),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _groups(batches, "shard"):
            table = shard.sort_by([("length", "descending"), ("key", "ascending"), ("piece", "ascending")])
            bins, places, sizes = pack(table["length"].to_numpy(), capacities)
            number = table["shard"][0].as_py()
            table = table.select(["key", "piece", "start", "length"])
            table = table.append_column("bin", pa.array([f"{number}-{b}" for b in bins.tolist()], pa.string()))
            table = table.append_column("capacity", pa.array(sizes[bins]))
            table = table.append_column("place", pa.array(places))
            yield from table.to_batches(max_chunksize=10_000)

    kind = dict(rests.dtypes)["key"]
    schema = f"key {kind}, piece bigint, start bigint, length bigint, bin string, capacity bigint, place bigint"
    # One shard to a task, which a hash of the shard's number would not give.
    dealt = rests.repartitionById(shards, "shard").sortWithinPartitions("shard")
    return (
        dealt.mapInArrow(packed, schema).unionByName(cut).unionByName(none)
        .withColumnRenamed("key", key)
    )


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Runs of equal values of a sorted column, each as one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(column)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def packing_query(docs: DataFrame) -> DataFrame:
    """Documents packed by the tokens that their texts encode to; each text is encoded once."""
    counted = with_lengths(docs.select("doc_id", "text")).select("doc_id", "n_tokens")
    return best_fit(land(counted, "token-counts"), "n_tokens")
