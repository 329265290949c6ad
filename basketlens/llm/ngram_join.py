"""N-gram Jaccard join with Bayesian pruning of candidates.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is ``THRESHOLD`` or more. Texts with equal sets count as copies of one
representative and are never paired. The steps:

1. Each text's shingles and a MinHash signature of ``BANDS * ROWS`` values.
2. Representatives which agree in all values of a band share a bucket. A pair at
   the threshold misses all buckets with probability (1 - 0.8**4)**24 < 4e-6.
   Within a bucket signatures are compared ``STEP`` values at a time; a pair is
   dropped once the posterior probability that its similarity reaches the threshold
   is below ``TOLERANCE``. What remains joins its members to clusters; a bucket
   passes on a spanning set of edges, no list of pairs.
3. The components of these edges hold all links. Within each, pairs go through the
   same pruning, and those that remain are verified with their shingles.
4. Links are added up for each representative, with the number of copies as
   weight; the components of the verified links are the classes.

Buckets and components of any size are cut into blocks of bounded size, each pair
of blocks being one tile; a tile is the most that a task holds. No step emits the
pairs of a group as rows.

Defined cases: a null or wordless text is linked to nothing; one of fewer than
five words has a single shingle; rows with a null id are linked to nothing and
keep a row each with a null class; repeated rows are one document, and two
different texts of one id are two documents of that name, also where their sets
are equal, so that classes may share the name of such an id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.components import components
from basketlens.llm.shingles import hash_family, shingle_sets, signature
from basketlens.llm.tables import WORD
from basketlens.sources.landing import land

THRESHOLD = (4, 5)
ROWS, BANDS = 4, 24
STEP = 16
TOLERANCE = 1e-6
#: Members of a bucket's block; and members and shingles of a component's block.
BUCKET_BLOCK = 1024
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 500_000
#: Pairs that are compared at once.
PAIRS = 1 << 19
#: Representatives whose ids are broadcast at most, rather than texts being shuffled.
BROADCAST_IDS = 500_000

HASHES = ROWS * BANDS


def least_matches(step: int = STEP, hashes: int = HASHES, threshold: float = THRESHOLD[0] / THRESHOLD[1],
                  tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number n of compared values, the matches without which a pair is dropped.

    With a uniform prior and m matches the similarity has the distribution
    Beta(m + 1, n - m + 1), which exceeds t with the probability that n + 1 draws of
    probability t succeed at most m times.
    """
    out = {}
    for n in range(step, hashes + 1, step):
        reach, m = 0.0, -1
        while reach < tolerance:
            m += 1
            reach += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def text_digest(text: str) -> Column:
    """16 bytes that tell apart the texts of one id; null for a null text."""
    return F.substring(F.unhex(F.sha2(F.col(text), 256)), 1, 16)


# --- in tasks ------------------------------------------------------------------


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text_key, set_key, n, sig) of each row: digests of text and shingle set, the set's size, its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(HASHES)
        for batch in batches:
            keys, sizes, signatures = [], [], []
            for s in shingle_sets(batch.column("text").to_pylist()):
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sizes.append(len(s))
                signatures.append(signature(s, family).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_key"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(signatures, pa.binary())],
                names=["doc", "text_key", "set_key", "n", "sig"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc"), text_digest(text).alias("text_key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc bigint, text_key binary, set_key binary, n bigint, sig binary")


def _pairs(tile: np.ndarray, block: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same tile, in portions; rows are sorted by tile.

    In a tile across two blocks, of which one may be empty, only rows of different
    blocks pair up.
    """
    n = len(tile)
    new = np.concatenate(([True], tile[1:] != tile[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    earlier = np.arange(n) - first
    ends = np.cumsum(earlier)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        count = earlier[at:to]
        right = np.repeat(np.arange(at, min(to, n)), count)
        within = np.arange(len(right)) - np.repeat(np.cumsum(count) - count, count)
        left = first[right] + within
        keep = ~cross[right] | (block[left] != block[right])
        yield left[keep], right[keep]
        at = to


def _surviving(left: np.ndarray, right: np.ndarray, sig: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs which no step of comparison drops."""
    matches = np.zeros(len(left), np.int32)
    for n, m in least.items():
        part = slice(n - STEP, n)
        matches += (sig[left, part] == sig[right, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= m
        left, right, matches = left[keep], right[keep], matches[keep]
    return left, right


def _merge(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels (the least row of each cluster) after linking rows left and right."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _whole_tiles(batches: Iterator[pa.RecordBatch], rows: int, size: int = 32 << 20) -> Iterator[pa.Table]:
    """Tables of whole tiles, of at least ``rows`` rows or ``size`` bytes but for the last; input is sorted by tile."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, rows)
            at += piece.num_rows
            held.append(piece)
            if sum(h.num_rows for h in held) < rows and sum(h.nbytes for h in held) < size:
                continue
            table = pa.Table.from_batches(held)
            tiles = table["tile"].to_numpy()
            others = np.flatnonzero(tiles != tiles[-1])
            cut = int(others[-1]) + 1 if len(others) else 0  # the last tile may go on
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def cluster_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges (a < b) of what survives in each tile of (tile, block, cross, rep, sig)."""
    least = least_matches()
    for table in _whole_tiles(batches, 8192):
        reps, sig = table["rep"].to_numpy(), _signatures(table["sig"])
        labels = np.arange(len(reps))
        for left, right in _pairs(*(table[c].to_numpy() for c in ("tile", "block", "cross"))):
            labels = _merge(labels, *_surviving(left, right, sig, least))
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        edges = np.unique(np.stack([reps[labels[linked]], reps[linked]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], names=["a", "b"])


def _verified(left: np.ndarray, right: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Which of the pairs of one tile reach the threshold exactly; pairs are sorted by left."""
    sizes = np.array([len(s) for s in sets])
    up, down = THRESHOLD
    out = np.zeros(len(left), bool)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    held = np.zeros(int(codes.max()) + 1, bool)
    firsts = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1])))
    for a, b in zip(firsts, [*firsts[1:], len(left)]):
        own = codes[starts[left[a]] : starts[left[a]] + sizes[left[a]]]
        held[own] = True
        others = right[a:b]
        if len(others) * 4 > len(sets):
            shared = np.add.reduceat(held[codes], starts, dtype=np.int64)[others]
        else:
            shared = np.array([np.count_nonzero(held[codes[starts[r] : starts[r] + sizes[r]]]) for r in others])
        held[own] = False
        # shared / (both - shared) >= up / down
        out[a:b] = shared * (up + down) >= up * (sizes[left[a]] + sizes[others])
    return out


def verified_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From tiles of (tile, block, cross, rep, copies, n, sig, shingles): rows (a, b, links).

    With b null, ``links`` is how many documents of the tile a is linked to; else a
    and b are an edge of a spanning set.
    """
    least = least_matches()
    up, down = THRESHOLD
    for table in _whole_tiles(batches, 4096):
        table = table.sort_by([("tile", "ascending"), ("rep", "ascending")])
        tiles, reps = table["tile"].to_numpy(), table["rep"].to_numpy()
        # A representative whose row is repeated comes only once.
        once = np.concatenate(([True], (tiles[1:] != tiles[:-1]) | (reps[1:] != reps[:-1])))
        table, tiles, reps = table.filter(pa.array(once)), tiles[once], reps[once]
        block, cross, copies = (table[c].to_numpy() for c in ("block", "cross", "copies"))
        sig, sizes = _signatures(table["sig"]), table["n"].to_numpy()
        labels, links = np.arange(len(reps)), np.zeros(len(reps), np.int64)
        bounds = np.flatnonzero(np.concatenate(([True], tiles[1:] != tiles[:-1])))
        shingles = table["shingles"]
        for a, b in zip(bounds, [*bounds[1:], len(tiles)]):
            sets = None
            for left, right in _pairs(tiles[a:b], block[a:b], cross[a:b]):
                small, large = np.minimum(sizes[a:b][left], sizes[a:b][right]), np.maximum(sizes[a:b][left], sizes[a:b][right])
                fits = small * down >= large * up
                left, right = _surviving(left[fits], right[fits], sig[a:b], least)
                if not len(left):
                    continue
                if sets is None:
                    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in shingles[a:b]]
                order = np.lexsort((right, left))
                left, right = left[order], right[order]
                keep = _verified(left, right, sets)
                left, right = left[keep] + a, right[keep] + a
                np.add.at(links, left, copies[right])
                np.add.at(links, right, copies[left])
                labels = _merge(labels, left, right)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([reps[some], reps[labels[linked]]])),
                pa.array([None] * len(some) + reps[linked].tolist(), pa.int64()),
                pa.array(np.concatenate([links[some], np.zeros(len(linked), np.int64)])),
            ],
            names=["a", "b", "links"],
        )


# --- stages ----------------------------------------------------------------------


def _tiled(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """``rows`` once for each tile they take part in, with ``tile``, ``block`` and ``cross``.

    A group of one block is one tile. Otherwise each pair of different blocks is a
    tile, and each block by itself.
    """
    placed = rows.withColumn("__blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("__blocks")).cast("int")
    )
    other = F.sequence(F.lit(0), (F.col("__blocks") - 1).cast("int"))
    spread = placed.withColumn("__other", F.explode(other))
    low, high = F.least("block", "__other"), F.greatest("block", "__other")
    named = spread.withColumn("tile", F.xxhash64(group, low, high)).withColumn("cross", low < high)
    return named.drop("__blocks", "__other")


def _with_roots(found: DataFrame) -> DataFrame:
    """(node, root) of ``components``, with the roots as nodes of their own."""
    return found.unionByName(found.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node")))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_key, class_id, n_links, is_first): a row for each document, with its text's digest.

    The class is named by its least id; ``n_links`` is the number of other documents
    whose similarity reaches the threshold. ``is_first`` marks the one document which
    stands for its class.
    """
    sketched = land(sketches(docs, key, text), "sketches")
    named = sketched.where("doc IS NOT NULL AND n > 0").select("doc", "text_key", "set_key", "sig", "n").distinct()
    reps = named.groupBy("set_key", "sig", "n").agg(
        F.min(F.struct("doc", "text_key")).alias("first"), F.count("*").alias("copies")
    )
    # Numbered as they are written: an id may stand for several texts, a number for one set only.
    reps = land(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    postings = reps.select(
        "rep",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda b: F.xxhash64(b, F.substring("sig", b * (2 * ROWS) + 1, F.lit(2 * ROWS))),
        )).alias("bucket"),
    )
    shared = postings.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = _tiled(postings.join(shared, "bucket"), "bucket", F.ceil(F.col("members") / BUCKET_BLOCK))
    with_sig = members.select("tile", "block", "cross", "rep").join(reps.select("rep", "sig"), "rep")
    tiles = with_sig.repartition("tile").sortWithinPartitions("tile", "rep").select("tile", "block", "cross", "rep", "sig")
    clusters = components(tiles.mapInArrow(cluster_edges, "a bigint, b bigint"))
    found = land(_verify(docs, reps, clusters, key, text), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    classes = components(found.where("b IS NOT NULL").select("a", "b"))
    linked_reps = _with_roots(classes).select(F.col("node").alias("rep"), "root")
    heads = linked_reps.join(reps.select("rep", "first"), "rep").groupBy("root").agg(F.min("first").alias("head"))
    known = (
        reps.select("set_key", "rep", "first", "copies")
        .join(links, "rep", "left")
        .join(linked_reps.join(heads, "root").select("rep", "head"), "rep", "left")
        .select(
            "set_key", F.coalesce("head", "first").alias("head"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    every = sketched.where("doc IS NOT NULL").select("doc", "text_key", "set_key", "n").distinct().unionByName(
        sketched.where("doc IS NULL").select("doc", "text_key", "set_key", "n")
    )
    linked = F.col("doc").isNotNull() & (F.col("n") > 0)
    joined = every.join(known, "set_key", "left")
    first = (F.col("doc") == F.col("head.doc")) & (F.col("text_key") == F.col("head.text_key"))
    return joined.select(
        F.col("doc").alias(key), "text_key",
        F.when(linked, F.col("head.doc")).otherwise(F.col("doc")).alias("class_id"),
        F.when(linked, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        (~linked | first).alias("is_first"),
    )


def _verify(docs: DataFrame, reps: DataFrame, clusters: DataFrame, key: str, text: str) -> DataFrame:
    """Links and edges within clusters, from the shingles of their members' texts."""
    inside = _with_roots(clusters).select(F.col("node").alias("rep"), F.col("root").alias("cluster"))
    members = land(inside.join(reps, "rep"), "clusters")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    blocks = sizes.select("cluster", F.greatest(
        F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
    ).alias("blocks"))
    placed = members.join(blocks, "cluster")
    small = members.count() <= BROADCAST_IDS
    wanted = members.select("rep", F.col("first.doc").alias("__doc"), F.col("first.text_key").alias("__text"))
    texts = docs.select(F.col(key).cast("long").alias("doc"), text_digest(text).alias("text_key"), F.col(text).alias("text"))
    same = (F.col("doc") == F.col("__doc")) & (F.col("text_key") == F.col("__text"))
    texts = texts.join(F.broadcast(wanted) if small else wanted, same).select("rep", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In small portions, as a text's shingles may be as large as the text.
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [s.tobytes() for s in shingle_sets(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    sets = texts.mapInArrow(shingled, "rep bigint, shingles binary")
    tiles = _tiled(placed, "cluster", F.col("blocks")).select("tile", "block", "cross", "rep", "copies", "n", "sig")
    full = tiles.join(sets, "rep").repartition("tile").sortWithinPartitions("tile", "rep")
    columns = ("tile", "block", "cross", "rep", "copies", "n", "sig", "shingles")
    return full.select(*columns).mapInArrow(verified_links, "a bigint, b bigint, links bigint")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with its columns as they are; rows with null ids stay.

    A repeated row counts as one document, too.
    """
    marked = land(join(docs, key, text), "classes")
    gone = marked.where("NOT is_first").select(F.col(key).alias("__gone"), F.col("text_key").alias("__gone_text"))
    same = (F.col(key) == F.col("__gone")) & (F.col("__text_key") == F.col("__gone_text"))
    kept = docs.withColumn("__text_key", text_digest(text)).join(gone, same, "left_anti").drop("__text_key")
    repeated = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__again")).agg(F.count("*").alias("c"))
    repeated = land(repeated.where("c > 1").select("__again"), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col(key) == F.col("__again"), "left_anti")
    several = kept.join(repeated, F.col(key) == F.col("__again"), "left_semi")
    return once.unionByName(several.dropDuplicates([key, text]))


def join_query(docs: DataFrame) -> DataFrame:
    return join(docs).select("doc_id", "class_id", "n_links")


JOIN_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE c * 9 >= 4 * (x.n + y.n)),
r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id),
k AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY doc_id)
SELECT k.doc_id, class_id, (SELECT count(*) FROM l WHERE l.a = k.doc_id) AS n_links FROM k"""
