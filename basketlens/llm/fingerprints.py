"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph, which is what stands between line ends, is hashed as a whole to a
wide vector of ``PARAGRAPH_LANES`` lanes of 32 bits, and these vectors are added
modulo 2**32. Equal sums tell equal multisets of paragraphs, up to chance.

For the likeness of texts that differ, a sketch goes with it. Every paragraph is cut into pieces of ``PIECE_WORDS`` words, counted from its
start, so that a change at its end leaves the earlier pieces alone. A piece is
hashed to a wide vector of ``LANES`` bits, and the vectors of all pieces are added
lane by lane. A 64-bit sum holds two lanes, ``SUM_BITS`` apart, so that both counts
are exact for under 2**31 pieces, which no single text exceeds. A vector is the
number of pieces, followed by the sums of pieces and the lanes of paragraphs.

Written, the vector of at most 16,383 pieces takes three lanes to a word,
``LANE_BITS`` apart, and that of more pieces takes its sums as they are; two lanes
of paragraphs take a word. ``read`` gives the same vector back from either.

The sums do not depend on the order of paragraphs. Adding or taking away the
fingerprint of some paragraphs gives that of the longer or shorter text, without
reading the rest (``combine``). Equal texts have equal fingerprints; texts with
other paragraphs have other fingerprints up to chance, about 2**-256 for a pair.

A bit stands for +1 or -1, so the scalar product of two fingerprints estimates
in how many pieces the texts agree: their likeness is the cosine, from 0 to 1,
with a standard error near 1/sqrt(LANES).

Defined cases: a null text counts as empty; line ends in a row, and at the ends of a
text, make no paragraph; a text of any length is read whole; an empty text has the fingerprint of
nothing, like 1 to another such text and 0 to every other; repeated rows each
give a row of their own; rows with a null id come last in the order of ids; rows of
one id, or without one, go by their texts' hashes, and any number of them is split by
these; an empty table gives no rows. Columns but the key and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.llm.tables import SPACE, WORD, whole
from basketlens.llm.warc import _place

PIECE_WORDS = 4
#: Each 64-bit hash of a piece gives 42 lanes: 21 sums of 2, written as 14 words of 3 where these hold the counts.
HASHES = 3
LANE_BITS = 14
WORDS = HASHES * LANE_BITS
LANES = 3 * WORDS
SUM_BITS = 31
SUMS_OF_HASH = LANES // HASHES // 2
SUMS = HASHES * SUMS_OF_HASH
#: Each 64-bit hash of a paragraph gives two lanes.
PARAGRAPH_HASHES = 4
PARAGRAPH_LANES = 2 * PARAGRAPH_HASHES
#: Documents that one slice of the id order should hold, and the slices' ranges.
SLICE_ROWS = 1000
RANGES = 512
MAX_SLICES = 65_536

_LOWEST_BITS = 1 | 1 << SUM_BITS
_LOW_LANES = (1 << SUMS_OF_HASH) - 1
_RANGE = 1 << LANE_BITS
_SUM_RANGE = 1 << SUM_BITS
_LANE = (1 << 32) - 1
# Set apart the hashes of paragraphs from those of pieces.
_PARAGRAPH_SEED = 100


def pieces(text: Column) -> Column:
    """The pieces of all paragraphs, which end at line ends."""
    between = SPACE.replace(r"\n\r", "")
    pattern = f"{WORD}(?:[{between}]+{WORD}){{0,{PIECE_WORDS - 1}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def paragraph_lanes(text: Column) -> Column:
    """The sum of the hash vectors of a text's paragraphs, modulo 2**32 in each lane."""

    def hashed(p: Column) -> Column:
        whole_hashes = [F.xxhash64(F.lit(_PARAGRAPH_SEED + k), p) for k in range(PARAGRAPH_HASHES)]
        return F.array(*[F.shiftrightunsigned(h, b).bitwiseAND(F.lit(_LANE)) for h in whole_hashes for b in (0, 32)])

    found = F.regexp_extract_all(text, F.lit(r"[^\n\r]+"), F.lit(0))
    none = F.array(*[F.lit(0).cast("long")] * PARAGRAPH_LANES)
    return F.aggregate(found, none, lambda acc, p: _added(acc, hashed(p)))


def _added(a: Column, b: Column, sign: int = 1) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + sign * y).bitwiseAND(F.lit(_LANE)))


def _tail(vector: Column) -> Column:
    """A vector's lanes of paragraphs."""
    return F.slice(vector, SUMS + 2, PARAGRAPH_LANES)


def _vector_sums(piece: Column, sign: Column) -> list[Column]:
    """For each hash and k below 21: its bit k, with bit k + 21 in the upper half, summed over the pieces."""
    hashes = [F.xxhash64(F.lit(k), piece) for k in range(HASHES)]
    spread = [
        h.bitwiseAND(F.lit(_LOW_LANES)).bitwiseOR(
            F.shiftleft(h.bitwiseAND(F.lit(_LOW_LANES << SUMS_OF_HASH)), SUM_BITS - SUMS_OF_HASH)
        )
        for h in hashes
    ]
    sums = [F.shiftrightunsigned(h, k) for h in spread for k in range(SUMS_OF_HASH)]
    return [F.sum(sign * w.bitwiseAND(F.lit(_LOWEST_BITS))) for w in sums]


def lanes(vector: Column) -> Column:
    """For each lane, bits set less bits not set: between minus and plus the number of pieces."""
    n = F.element_at(vector, 1)

    def both(word: Column) -> Column:
        low = word.bitwiseAND(F.lit(_SUM_RANGE - 1))
        return F.array(2 * low - n, 2 * F.shiftright(word, SUM_BITS) - n)

    return F.flatten(F.transform(F.slice(vector, 2, SUMS), both))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x * y).cast("double")), F.lit(0.0), add)


def _cosine(x: Column, y: Column, equal: Column) -> Column:
    size = F.sqrt(_dot(x, x)) * F.sqrt(_dot(y, y))
    cosine = F.when(size > 0, _dot(x, y) / size).otherwise(0.0)
    # Unequal fingerprints stay below 1, so that 1 means equal.
    return F.when(equal, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0 - 2.0**-20)))


def with_likeness(rows: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with the cosine of two fingerprint vectors for each name in ``pairs``.

    From 0 to 1, and 1 exactly for equal fingerprints. Lanes are taken apart once.
    """
    vectors = sorted({v for pair in pairs.values() for v in pair})
    apart = rows.select("*", *[lanes(F.col(v)).alias(f"__{v}") for v in vectors])
    found = [
        _cosine(F.col(f"__{a}"), F.col(f"__{b}"), F.col(a) == F.col(b)).alias(name)
        for name, (a, b) in pairs.items()
    ]
    return apart.select(*rows.columns, *found)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector after inserting (1) or deleting (-1) the paragraphs that ``b`` stands for."""
    counts = F.zip_with(F.slice(a, 1, SUMS + 1), F.slice(b, 1, SUMS + 1), lambda x, y: x + sign * y)
    return F.concat(counts, _added(_tail(a), _tail(b), sign))


def _packed(vector: Column) -> Column:
    """The number of pieces, at most 16,383, and the words of three lanes."""

    def count(h: int, bit: int) -> Column:
        word = F.element_at(vector, 2 + SUMS_OF_HASH * h + bit % SUMS_OF_HASH)
        return word.bitwiseAND(F.lit(_SUM_RANGE - 1)) if bit < SUMS_OF_HASH else F.shiftright(word, SUM_BITS)

    words = [
        reduce(add, [F.shiftleft(count(h, k + part * LANE_BITS), part * LANE_BITS) for part in range(3)])
        for h in range(HASHES) for k in range(LANE_BITS)
    ]
    return F.array(F.element_at(vector, 1), *words)


def _unpacked(words: Column) -> Column:
    """The vector of what ``_packed`` gives."""

    def count(h: int, bit: int) -> Column:
        word = F.element_at(words, 2 + LANE_BITS * h + bit % LANE_BITS)
        return F.shiftright(word, bit // LANE_BITS * LANE_BITS).bitwiseAND(F.lit(_RANGE - 1))

    sums = [
        count(h, k) + F.shiftleft(count(h, k + SUMS_OF_HASH), SUM_BITS)
        for h in range(HASHES) for k in range(SUMS_OF_HASH)
    ]
    return F.array(F.element_at(words, 1), *sums)


def written(vector: Column) -> Column:
    """A vector as hexadecimal text, 16 characters for each word, packed where the counts fit."""
    fits = F.element_at(vector, 1).between(0, _RANGE - 1)
    words = F.when(fits, _packed(vector)).otherwise(F.slice(vector, 1, SUMS + 1))
    lanes_of = [F.element_at(vector, SUMS + 2 + i) for i in range(PARAGRAPH_LANES)]
    pairs = [F.shiftleft(b, 32).bitwiseOR(a) for a, b in zip(lanes_of[::2], lanes_of[1::2])]
    words = F.concat(words, F.array(*pairs))
    return F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), 16, "0")), "")


def read(text: Column) -> Column:
    """The vector of a written fingerprint."""

    def half(at: Column) -> Column:
        return F.conv(F.substr(text, at, F.lit(8)), 16, 10).cast("long")

    last = F.floor(F.length(text) / 16).cast("int") - 1
    words = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.shiftleft(half(16 * i + 1), 32).bitwiseOR(half(16 * i + 9)),
    )

    def vector(w: Column) -> Column:
        counts = F.slice(w, F.lit(1), F.size(w) - PARAGRAPH_HASHES)
        pairs = F.slice(w, -PARAGRAPH_HASHES, PARAGRAPH_HASHES)
        apart = F.transform(pairs, lambda x: F.array(x.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(x, 32)))
        packed = F.size(w) == WORDS + 1 + PARAGRAPH_HASHES
        return F.concat(F.when(packed, _unpacked(counts)).otherwise(counts), F.flatten(apart))

    # Within a function, so that the words are read once.
    return F.element_at(F.transform(F.array(words), vector), 1)


def _parts(text: Column, part: int = 0) -> Column:
    """A text's pieces, and once, without a piece, the lanes of its paragraphs."""
    lanes_type = "array<bigint>"
    cut = F.transform(pieces(text), lambda p: F.struct(
        F.lit(part).alias("part"), p.alias("piece"), F.lit(None).cast(lanes_type).alias("paragraphs")
    ))
    once = F.struct(
        F.lit(part).alias("part"), F.lit(None).cast("string").alias("piece"),
        paragraph_lanes(text).alias("paragraphs"),
    )
    return F.array_append(cut, once)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the ``vector`` of all their pieces and paragraphs; see ``_parts``."""
    piece = F.coalesce("piece", F.lit(""))
    sign = F.when(F.col("piece").isNotNull(), 1).otherwise(0).cast("long")
    none = F.lit(0).cast("long")
    lane_sums = [F.sum(F.coalesce(F.element_at("paragraphs", i + 1), none)) for i in range(PARAGRAPH_LANES)]
    sums = [F.sum(sign), *_vector_sums(piece, sign), *[s.bitwiseAND(F.lit(_LANE)) for s in lane_sums]]
    named = [s.alias(f"v{i}") for i, s in enumerate(sums)]
    vector = F.array(*[F.col(f"v{i}") for i in range(len(sums))]).alias("vector")
    return rows.groupBy(*keys).agg(*named).select(*keys, vector)


def fingerprint(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``vector`` for each value of ``keys``: the multiset of all its texts' pieces.

    The pieces are summed before they are shuffled, so a hot key costs one row
    from each task.
    """
    return _summed(docs.select(*keys, F.inline(_parts(whole(text)))), keys)


def _slices(docs: DataFrame, key: str, text: str) -> tuple[Column, Column, Column]:
    """For a row: its slice of the order, the slice before that, and whether it is its slice's first.

    Slices have higher numbers for higher ids; before the highest one comes the
    lowest. Ranges of about equal numbers of rows are cut into slices of equal
    width, so neither gaps nor dense places in the ids make a slice large. An id of
    more rows than a slice should hold, or null, is a range of its own and cut by
    its texts' hashes, so any number of texts may share it. What comes to the driver
    are ``RANGES`` limits, and a line for each such id and for each slice, of which
    there are a few times ``MAX_SLICES`` at most. Texts are read only if there is such an id.
    """
    ids = docs.select(F.col(key).cast("long").alias("id"))
    n = ids.count()
    rows = max(SLICE_ROWS, n // MAX_SLICES)
    counts = ids.groupBy("id").agg(F.count("*").alias("n"))
    hot = {r.id: r.n for r in counts.where(F.col("n") > rows).collect()}
    ranges = max(1, min(RANGES, n // SLICE_ROWS))
    marks = [i / ranges for i in range(ranges)]
    stats = ids.where("id IS NOT NULL").agg(
        F.percentile_approx("id", marks, 20 * RANGES).alias("marks"),
        F.min("id").alias("low"), F.max("id").alias("high"),
    ).first()
    low, high = (0, 0) if stats.low is None else (stats.low, stats.high)
    alone = {e for h in hot if h is not None for e in (h, h + 1)}
    edges = sorted({low, *(stats.marks or []), *(e for e in alone if e <= high)})
    parts = max(1, -(-n // (rows * len(edges))))
    cut = [-(-hot[e] // rows) if e in hot else parts for e in edges]
    widths = [-(-(b - a) // parts) for a, b in zip(edges, [*edges[1:], high + 1])]
    # The first slices have the null ids, which come last.
    nulls = -(-hot.get(None, 1) // rows)
    starts = list(accumulate(cut[:-1], initial=nulls + 1))
    at = F.greatest(_place(edges, F.col(key).cast("long")), F.lit(1))

    def of_range(values: list) -> Column:
        return F.element_at(F.lit(values), at)

    def by_hash(slices: Column) -> Column:
        # The hash's upper half from 0 on; lower hashes come first, in higher slices.
        upper = F.shiftright(F.xxhash64(whole(text)), 32) + 2**31
        return slices - 1 - F.shiftright(upper * slices.cast("long"), 32)

    inside = F.least(F.floor((F.col(key) - of_range(edges)) / of_range(widths)), of_range(cut) - 1)
    if alone:
        inside = F.when(of_range([e in hot for e in edges]), by_hash(of_range(cut))).otherwise(inside)
    last = by_hash(F.lit(nulls)) + 1 if None in hot else F.lit(1)
    number = F.when(F.col(key).isNull(), last).otherwise(of_range(starts) + inside).cast("int")

    top = [F.max(F.col(key).cast("long")).alias("id")]
    if hot:
        top.append(F.min(F.xxhash64(whole(text))).alias("hash"))
    found = {r.slice: r for r in docs.groupBy(number.alias("slice")).agg(*top).collect()}
    order = sorted(found, reverse=True)
    previous = {s: order[i - 1] for i, s in enumerate(order)}
    every = range(1, starts[-1] + cut[-1])

    def looked_up(value: Callable[[int], int | bool]) -> Column:
        # The array has no null: what a slice without rows, or of null ids, has is never used.
        return F.element_at(F.lit([value(s) for s in every]), F.col("slice"))

    highest = looked_up(lambda s: (found[s].id or 0) if s in found else 0).cast("long")
    first = F.col("id").eqNullSafe(F.when(F.col("slice") > nulls, highest))
    if hot:
        split = {s for e, start, c in zip(edges, starts, cut) if e in hot for s in range(start, start + c)}
        split |= set(range(1, nulls + 1)) if None in hot else set()
        least = looked_up(lambda s: found[s].hash if s in found else 0).cast("long")
        first &= ~looked_up(lambda s: s in split) | (F.xxhash64("text") == least)
    return number, looked_up(lambda s: previous.get(s, 0)), first


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and of the next document.

    The edited text has its last third replaced by the start of the next
    document, in descending order of ``key``, then by the text's hash and the
    text; the first follows the last. Documents are dealt to slices of that order
    once, and the first of each slice is also sent to the slice before it, so that
    neighbours meet without a global sort.
    """
    number, before, first = _slices(docs, key, text)
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.col(key).alias("key"),
        whole(text).alias("text"), number.alias("slice"),
    )
    here = F.struct(F.col("slice"), F.lit(0).alias("guest"))
    there = F.struct(before.alias("slice"), F.lit(1).alias("guest"))
    # A slice's first row is a guest in the slice before, where it comes last.
    places = F.when(first, F.array(here, there)).otherwise(F.array(here))
    rows = rows.select("id", "key", "text", F.inline(places))
    order = W.partitionBy("slice").orderBy(
        "guest", F.col("id").desc_nulls_last(), F.xxhash64("text"), "text"
    )
    n = F.length("text")
    share = F.floor(n / 3).cast("int")
    near = rows.select(
        "slice", "guest", "key", "text", F.row_number().over(order).alias("row"),
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("following"),
    )
    edited = F.concat(
        F.substr("text", F.lit(1), n - share), F.substr("following", F.lit(1), share)
    )
    changed = near.select(
        "slice", "row", "guest", "key", "text", n.cast("long").alias("n_chars"), edited.alias("edited")
    # Before the pieces are laid out, or every piece's row would carry and hash the text.
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["slice", "row", "part", "guest", "key", "n_chars", "edited_sha256"]
    pieced = changed.select(
        "slice", "row", "guest", "key", "n_chars", "edited_sha256",
        F.inline(F.concat(_parts(F.col("text")), _parts(F.col("edited"), 1))),
    )
    # A text's row is followed by its edited text's and then by the next text's.
    following = W.partitionBy("slice").orderBy("row", "part")
    return (
        _summed(pieced, keys)
        .withColumn("edited_vector", F.lead("vector", 1).over(following))
        .withColumn("next_vector", F.lead("vector", 2).over(following))
        .where("guest = 0 AND part = 0")
        .select(F.col("key").alias(key), "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector")
    )


def fingerprints_query(docs: DataFrame) -> DataFrame:
    found = with_likeness(edited_fingerprints(docs), {
        "near_edited": ("vector", "edited_vector"), "near_next": ("vector", "next_vector"),
    })
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("vector")).alias("fingerprint"),
        written(F.col("edited_vector")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
